"""Near duplicates by an LSH forest of MinHash signatures.

A document is the set of its distinct five-word shingles.  Documents with the same
set are one node, the smallest id among them.  A node has ``HASHES`` minima; each
of ``TREES`` trees sorts all nodes by a string of minima of its own.

1. Neighbours.  In each sorted order a node and its predecessor with a common
   prefix of ``DEPTH`` minima or more are candidates; the deeper the common prefix,
   the likelier, and in crowded regions neighbours share deep ones by themselves.
   Of a node's predecessors in all trees the one met most often is compared.
2. Regions.  What round 1 has not put into one component is compared within the
   regions of a common prefix, signature by signature; a crowded region is dealt in
   pairs of blocks of ``CROWD`` nodes.  Twice each node proposes only the likeliest
   node of another component, which joins large families with few comparisons of
   sets.  Then the sets of the nodes that still have a candidate in another component
   come together by region, and all their pairs are confirmed there: pairs are no rows,
   each is looked at in the first tree that has it, and a task gives only links that
   join components it has not joined yet.  Nothing is cut off.  Signatures rule out
   what is far from similar.

Candidates are confirmed on full sets.  Links make components by the alternating
star method, on tables.  A pair of similarity 0.75 misses all regions with
probability (1 - 0.75**3)**32 = 2e-8.  Signatures rule out a pair of that similarity
(estimate under ``FLOOR``) with probability below 1e-6.

Cases: a text that is null or without words has no set and is linked with nothing.
Of rows with the same id, the one whose set has the smallest hash makes links; the
others go with the documents that have their set, if any.  Rows without id are returned, linked with nothing, and kept.  An empty
table gives no rows.  Other columns are not looked at.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tributary.llm import tables, words
from tributary.operators import scale

TREES, DEPTH, OWN = 32, 3, 4
HASHES = TREES * OWN
FLOOR = 0.55
CROWD = 2048
#: Shingles that weigh as one node in a block.
LOAD = 512

_RANDOM = np.random.default_rng(75)
_A = _RANDOM.integers(1, 2**32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RANDOM.integers(0, 2**32, HASHES, dtype=np.uint32)


def _sets(column):
    """The sorted distinct shingles of each text of an Arrow column."""
    data, offsets = words.utf8(column)
    for i, j in words.slices(offsets):
        hashes, bounds = words.word_hashes(
            data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        )
        runs, ends = words.shingles(hashes, bounds)
        for a, b in zip(ends, ends[1:]):
            yield np.unique(runs[a:b])


def signature(shingles):
    """Minima of ``HASHES`` hash functions over a set."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(low), 256):
        part = low[i : i + 256, None] * _A + _B
        np.minimum(least, part.min(axis=0), out=least)
    return least


def features(docs):
    """Per document: size and hash of its set, and its signature."""

    def made(batches):
        for batch in batches:
            sizes, sums, signatures = [], [], []
            for held in _sets(batch.column("text")):
                sizes.append(len(held))
                some = len(held) > 0
                sums.append(hashlib.md5(held.tobytes()).hexdigest() if some else None)
                signatures.append(signature(held).tobytes() if some else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(sums, pa.string()), pa.array(signatures, pa.binary())],
                ["doc_id", "n_shingles", "set_hash", "signature"],
            )

    return docs.mapInArrow(
        made, "doc_id bigint, n_shingles bigint, set_hash string, signature binary"
    )


def _minima(column):
    """The signatures of an Arrow column, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _prefixes(minima):
    """The region of each node (row) in each tree (column)."""
    trees = np.arange(TREES)
    region = np.zeros((len(minima), TREES), np.uint64) + trees.astype(np.uint64)
    for d in range(DEPTH):
        region = words.mix(region * words._ORDER[0] + minima[:, trees * OWN + d])
    return region


def forest(nodes):
    """One row per node and tree: its region, and the order within the region."""

    def planted(batches):
        trees = np.arange(TREES)
        for batch in batches:
            minima = _minima(batch.column("signature")).astype(np.uint64)
            region = _prefixes(minima)
            # Deeper minima: the tree's last one, and one of the next tree.
            later = minima[:, trees * OWN + DEPTH] << np.uint64(32)
            later |= minima[:, (trees * OWN + OWN) % HASHES]
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(region.view(np.int64).ravel()), pa.array(later.view(np.int64).ravel()),
                 pa.array(np.repeat(ids, TREES))],
                ["region", "later", "id"],
            )

    return nodes.select("id", "signature").mapInArrow(
        planted, "region bigint, later bigint, id bigint"
    )


def neighbours(rows):
    """Each node with the predecessor that it has in most of the sorted orders."""
    # A region with over a thousandth of all rows is sorted in salted parts, dealt
    # otherwise in every tree; what the parts leave apart is for the second round.
    hot = scale.hot_keys(rows, "region", min_rows=20_000).withColumn("hot", F.lit(True))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("id", "region"), F.lit(64)))
    dealt = rows.join(F.broadcast(hot), "region", "left").withColumn(
        "salt", F.coalesce(salt, F.lit(0).cast("bigint"))
    )
    order = W.partitionBy("region", "salt").orderBy("later", "id")
    met = dealt.withColumn("other", F.lag("id").over(order)).where("other is not null")
    often = met.groupBy("id", "other").agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by("other", F.struct("n", -F.col("other")))
    return often.groupBy("id").agg(best.alias("other")).select(
        F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")
    ).distinct()


def _held(ids, nodes, texts):
    """The sets of the nodes ``ids``: id, size, held (sorted shingles of 8 bytes)."""
    ids = nodes.join(ids, "id", "left_semi").select(F.col("id").alias("doc_id"), "set_hash")

    def sets(batches):
        for batch in batches:
            held = [x.tobytes() for x in _sets(batch.column("text"))]
            sums = batch.column("set_hash").to_pylist()
            # Of several rows with an id, that which stands for it.
            good = pa.array([hashlib.md5(x).hexdigest() == y for x, y in zip(held, sums)], pa.bool_())
            sizes = pa.array([len(x) // 8 for x in held], pa.int64())
            columns = [batch.column("doc_id"), sizes, pa.array(held, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.filter(good) for c in columns], ["id", "size", "held"])

    return tables.written(
        texts.join(ids, "doc_id")
        .select("doc_id", "text", "set_hash")
        .mapInArrow(sets, "id bigint, size bigint, held binary")
        .dropDuplicates(["id"]),
        "dedup-sets",
    )


def confirmed(pairs, nodes, texts, percent=75):
    """The pairs (a, b) of which ``percent`` of the union is common to both sets."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    held = _held(ids, nodes, texts)

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")],
                ["a", "b"],
            )

    left = held.select(F.col("id").alias("a"), F.col("held").alias("x"))
    right = held.select(F.col("id").alias("b"), F.col("held").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(compare, "a bigint, b bigint")


def components(links):
    """Smallest id reachable from each id in ``links`` (columns a, b)."""
    edges = tables.written(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
        .where("v <> m").distinct(), "dedup-edges",
    )
    state = None
    while True:
        sums = F.sum(F.xxhash64("v", "m").cast("decimal(20,0)"))
        now = tuple(edges.agg(F.count(F.lit(1)), sums).first())
        if now == state:
            break
        state = now
        # Large star: every larger neighbour of a node goes to its smallest one.
        both = edges.select(F.col("v").alias("u"), F.col("m").alias("w")).union(
            edges.select(F.col("m").alias("u"), F.col("v").alias("w"))
        )
        least = both.groupBy("u").agg(F.least(F.min("w"), F.min("u")).alias("m"))
        large = both.join(least, "u").where("w > u").select(F.col("w").alias("v"), "m")
        # Small star: every smaller neighbour, and the node, to the smallest one.
        least = large.groupBy(F.col("v").alias("u")).agg(F.min("m").alias("m"))
        lower = large.select(F.col("v").alias("u"), F.col("m").alias("w"))
        small = lower.join(least, "u").where("w <> m").select(F.col("w").alias("v"), "m")
        edges = tables.written(
            small.union(least.select(F.col("u").alias("v"), "m")).distinct(), "dedup-edges"
        )
    return edges.groupBy(F.col("v").alias("id")).agg(F.min("m").alias("component"))


def _placed(rows, labels):
    """The rows of a forest with the component of each node."""
    return rows.join(labels, "id", "left").select(
        "region", "id", F.coalesce("component", "id").alias("component")
    )


def _dealt(members, nodes):
    """``members`` (region, id, component, load) of the regions that have several
    components, with their signatures, once per task (region, lower, upper) that
    compares a block with another one or with itself."""
    mixed = members.groupBy("region").agg(
        F.sum("load").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    mixed = mixed.where("x <> y").select(
        "region", F.ceil(F.col("n") / CROWD).cast("int").alias("blocks")
    )
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # Each block meets each other, and itself, in a task of their own.
    met = F.sequence(F.lit(0), F.col("blocks") - 1)
    return (
        members.join(mixed, "region")
        .withColumn("block", block)
        .withColumn("met", F.explode(met))
        .select(
            "region", "id", "component", "block",
            F.least("block", "met").alias("lower"), F.greatest("block", "met").alias("upper"),
        )
        .join(nodes.select("id", "signature"), "id")
    )


_TASK = ["region", "lower", "upper"]


def _mates(table):
    """For the nodes of one task two functions of a node's place and the components of
    all: which nodes after it, of other components, signatures leave as candidates."""
    block, minima = table.column("block").to_numpy(), _minima(table.column("signature"))
    alone = table.column("lower")[0].as_py() == table.column("upper")[0].as_py()

    def of(i, part):
        other = part[i + 1 :] != part[i]
        if not alone:
            other &= block[i + 1 :] != block[i]
        j = np.flatnonzero(other) + i + 1
        same = (minima[j] == minima[i]).sum(axis=1)
        return j[same >= FLOOR * HASHES], same[same >= FLOOR * HASHES]

    tree = _prefixes(minima[:1].astype(np.uint64))[0].view(np.int64)
    tree = int(np.flatnonzero(tree == table.column("region")[0].as_py())[0])

    def first(i, part):
        """Those that meet ``i`` in no tree before this one, likeliest first."""
        j, same = of(i, part)
        met = (minima[j] == minima[i]).reshape(-1, TREES, OWN)[:, :, :DEPTH].all(axis=2)
        here = met.argmax(axis=1) == tree
        return j[here][np.argsort(-same[here], kind="stable")]

    return of, first


def _by_id(table):
    return table.take(pc.sort_indices(table, [("id", "ascending")]))


def _likeliest(rows, nodes, labels):
    """Candidates (a, b): each node with the likeliest one of another component."""
    members = _dealt(_placed(rows, labels).withColumn("load", F.lit(1)), nodes)

    def compare(table):
        table = _by_id(table)
        ids, part = (table.column(c).to_numpy() for c in ("id", "component"))
        of, _ = _mates(table)
        mate, top = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for i in range(len(ids) - 1):
            j, same = of(i, part)
            if not len(j):
                continue
            more = same > top[j]
            mate[j[more]], top[j[more]] = ids[i], same[more]
            k = same.argmax()
            if same[k] > top[i]:
                mate[i], top[i] = ids[j[k]], same[k]
        found = [x[top > 0] for x in (ids, mate, top)]
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("x", "y", "same"), found)})

    met = members.groupBy(*_TASK).applyInArrow(compare, "x bigint, y bigint, same bigint")
    met = met.groupBy("x").agg(F.max_by("y", F.struct("same", -F.col("y"))).alias("y"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _undecided(rows, nodes, labels):
    """The rows (region, id, component) of nodes that have a candidate of another
    component in a region, in the first tree in which both meet."""
    members = _dealt(_placed(rows, labels).withColumn("load", F.lit(1)), nodes)

    def marked(table):
        table = _by_id(table)
        part = table.column("component").to_numpy()
        _, first = _mates(table)
        some = np.zeros(len(part), bool)
        for i in range(len(part) - 1):
            j = first(i, part)
            some[j] = True
            some[i] |= len(j) > 0
        return table.select(["region", "id", "component"]).filter(pa.array(some))

    met = members.groupBy(*_TASK).applyInArrow(marked, "region bigint, id bigint, component bigint")
    return met.distinct()


def _links(members, nodes, texts, percent):
    """Links (a, b) between components among all pairs of ``members`` (region, id,
    component): of each task as many as join what its pairs of ``percent`` join."""
    held = _held(members.select("id").distinct(), nodes, texts)
    load = F.greatest(F.lit(1), F.ceil(F.col("size") / LOAD))
    members = members.join(held.select("id", "size"), "id").withColumn("load", load)
    members = _dealt(members, nodes).join(held, "id")

    def linked(table):
        table = _by_id(table)
        ids, size = (table.column(c).to_numpy() for c in ("id", "size"))
        part = table.column("component").to_numpy().copy()
        _, first = _mates(table)
        shingles = np.frombuffer(b"".join(table.column("held").to_pylist()), np.uint64)
        known, shingles = np.unique(shingles, return_inverse=True)
        ends = np.cumsum(size)
        own = np.zeros(len(known), bool)
        found = [[], []]
        for i in range(len(ids) - 1):
            j = first(i, part)
            less, more = np.minimum(size[j], size[i]), np.maximum(size[j], size[i])
            j = j[100 * less >= percent * more]
            if not len(j):
                continue
            own[shingles[ends[i] - size[i] : ends[i]]] = True
            for k in j.tolist():
                if part[k] == part[i]:
                    continue
                common = np.count_nonzero(own[shingles[ends[k] - size[k] : ends[k]]])
                if 100 * common >= percent * (size[i] + size[k] - common):
                    part[part == part[k]] = part[i]
                    found[0].append(ids[i])
                    found[1].append(ids[k])
            own[shingles[ends[i] - size[i] : ends[i]]] = False
        return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("a", "b"), found)})

    return members.groupBy(*_TASK).applyInArrow(linked, "a bigint, b bigint")


def _joined(labels, links):
    """``labels`` (id, component) after ``links`` between nodes: components of
    components, so that a family joined before counts as one node."""
    for end in ("a", "b"):
        known = labels.select(F.col("id").alias(end), "component")
        links = links.join(known, end, "left").withColumn(end, F.coalesce("component", end))
        links = links.drop("component")
    # A node that stands for a component is not itself in ``labels``.
    wider = tables.written(components(links), "dedup-labels")
    grown = wider.select(F.col("id").alias("component"), F.col("component").alias("wider"))
    moved = labels.join(grown, "component", "left").select(
        "id", F.coalesce("wider", "component").alias("component")
    )
    return moved.unionByName(wider)


def near_duplicates(docs, percent=75):
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    texts = tables.documents(docs)
    made = tables.written(features(texts), "dedup-features")
    known = made.where("doc_id is not null and set_hash is not null")
    # One set per id, the same whichever row comes first.
    own = known.groupBy("doc_id").agg(F.min("set_hash").alias("set_hash"))
    ids = own.groupBy("set_hash").agg(F.min("doc_id").alias("id"))
    minima = known.groupBy("set_hash").agg(F.first("signature").alias("signature"))
    nodes = ids.join(minima, "set_hash")
    nodes = tables.written(nodes, "dedup-nodes")
    rows = forest(nodes)
    crowded = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = tables.written(rows.join(crowded.select("region"), "region", "left_semi"), "dedup-forest")
    texts = texts.where("doc_id is not null").select("doc_id", "text")

    links = tables.written(confirmed(neighbours(rows), nodes, texts, percent), "dedup-links")
    labels = tables.written(components(links), "dedup-labels")
    for step in (_likeliest, _likeliest, _undecided):
        rest = tables.written(step(rows, nodes, labels), "dedup-candidates")
        if rest.isEmpty():
            break
        more = (_links if step is _undecided else confirmed)(rest, nodes, texts, percent)
        labels = tables.written(_joined(labels, more), "dedup-labels")
    named = nodes.select("set_hash", "id").join(labels, "id", "left").select(
        "set_hash", F.coalesce("component", "id").alias("component_id")
    )
    placed = scale.skew_join(
        made.select("doc_id", "n_shingles", "set_hash"), named, "set_hash", "left", small=False
    )
    component = F.coalesce("component_id", "doc_id")
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
