"""Lexical retrieval packing: fill windows of tokens with related documents.

Every document's ids, closed by ``end``, are cut into whole windows and one rest.
Whole windows are sequences of their own.  Rests are dealt to shards of at most
about ``shard`` rests by content, so that lexical neighbours meet; each shard keeps
an inverted index with BM25 weights (document frequencies counted over all rests of
the corpus).  The first unused rest seeds a window, and the unused rests that score
highest against all of the seed's tokens fill it, the last of them cut to fit; what
is left of it stays unused, at the head of the queue.  A seed without unused
neighbours goes on with the next unused rest, so each shard leaves one window
unfilled at most.

Dealing: a rest is the sum of random directions of its tokens, weighted as in BM25;
tokens of one rest only count nothing.  ``PIVOTS`` rests for each shard, picked by a
hash, are pivots, the square root of their number are heads.  A rest goes to the
nearest head, then to the nearest pivot of that head.  Pivots with few rests share
a shard with the next ones, one with too many is split by a hash, so a group of like
documents is spread over shards, however large it is.  A neighbour
beyond the border of a shard is not seen; README says how many that are.

Cases: a null or empty text is one piece with only the closing id.  Rows with the
same id, or without one, are packed each for itself.  An empty table gives no
pieces.  Only id and text of the input are looked at.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tributary.llm import bpe, tables

#: Rests per shard, pivots for each, and numbers of a rest's direction.
SHARD, PIVOTS, WIDTH = 1000, 4, 128
K1, B = 1.2, 0.75
#: Ids that this part of a shard's rests holds have their weights as a plain row.
COMMON = 1 / 16

_PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, rest bigint, ids binary"
)
_PACKED = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
    " sequence_id bigint, offset bigint, ids binary"
)


def pieces(docs, path, window=1024, end=0):
    """Whole windows of every document, and its rest, with ids (see ``bpe.compact``).

    ``sequence_id`` is set for whole windows, ``rest`` numbers the rests.
    """
    kind = bpe.compact(path)

    def cut(batches):
        known, task, made = bpe.codec(path), TaskContext.get().partitionId() << 33, 0
        close = np.array([end], "<u4").tobytes()
        names = [f.split()[0] for f in _PIECES.split(", ")]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in bpe.batches(texts):
                rows = []
                for doc, raw in zip(ids[i:j], known.encode(texts[i:j])):
                    raw += close
                    total = len(raw) // 4
                    small = np.frombuffer(raw, "<u4").astype(kind)
                    for start in range(0, total, window):
                        part = raw[4 * start : 4 * (start + window)]
                        whole = len(part) == 4 * window
                        made += 1
                        rows.append((
                            doc, start, len(part) // 4, zlib.crc32(part), total,
                            (1 << 62) + task + made if whole else None,
                            None if whole else task + made, small[start : start + window].tobytes(),
                        ))
                if rows:
                    columns = map(list, zip(*rows))
                    kinds = [*[pa.int64()] * 7, pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names
                    )

    return tables.documents(docs).mapInArrow(cut, _PIECES)


def frequencies(rests, size, kind):
    """How many rests hold each id: one row per id (at most ``size``)."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total[np.unique(np.frombuffer(raw, kind))] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["id", "n"])

    counted = rests.select("ids").mapInArrow(count, "id bigint, n bigint")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


class _Map:
    """Directions of rests, and the pivots that they are dealt to."""

    def __init__(self, inverse, often, mean):
        # An id that no other rest holds brings none together.
        self.pull, self.mean = np.where(often > 1, inverse, 0).astype(np.float32), mean
        self.pivots = self.heads = None

    def directions(self, raws, kind):
        """One row of length one for each rest."""
        rng = np.random.default_rng(11)
        signs = rng.integers(0, 2, (len(self.pull), WIDTH), np.int8) * np.int8(2) - np.int8(1)
        return np.array([self._direction(np.frombuffer(raw, kind), signs) for raw in raws],
                        np.float32).reshape(-1, WIDTH)

    def _direction(self, ids, signs):
        terms, often = np.unique(ids, return_counts=True)
        norm = K1 * (1 - B + B * len(ids) / self.mean)
        weight = self.pull[terms] * (often * (K1 + 1) / (often + norm)).astype(np.float32)
        made = weight @ signs[terms].astype(np.float32)
        return made / max(np.linalg.norm(made), 1e-9)

    def grow(self, points):
        """Take ``points`` as pivots, sorted by their heads."""
        self.heads = points[: int(np.ceil(np.sqrt(len(points))))]
        head = (points @ self.heads.T).argmax(axis=1)
        order = np.argsort(head, kind="stable")
        self.pivots = points[order]
        self.begin = np.searchsorted(head[order], np.arange(len(self.heads) + 1))

    def leaves(self, points):
        """The number of each point's pivot."""
        head = (points @ self.heads.T).argmax(axis=1)
        leaf = np.zeros(len(points), np.int64)
        for h in np.unique(head):
            a, b = self.begin[h], self.begin[h + 1]
            if b > a:
                leaf[head == h] = a + (points[head == h] @ self.pivots[a:b].T).argmax(axis=1)
        return leaf


def _placed(rests, world, kind, shard):
    """``rests`` with the number of their shard."""
    context = rests.sparkSession.sparkContext
    held = context.broadcast(world)

    def directed(batches):
        for batch in batches:
            raws = batch.column(0).to_pylist()
            for i in range(0, len(raws), 4096):
                rows = held.value.directions(raws[i : i + 4096], kind)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(i, 4096), pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["rest", "v"],
                )

    # A few hundred bytes for each pivot come to the driver.
    every = max(1, shard // PIVOTS)
    picked = rests.where(F.pmod(F.xxhash64("rest"), F.lit(every)) == 0).select("ids", "rest")
    picked = sorted((r.rest, bytes(r.v)) for r in picked.mapInArrow(directed, "rest bigint, v binary").collect())
    points = b"".join(v for _, v in picked) or np.eye(1, WIDTH, dtype=np.float32).tobytes()
    world.grow(np.frombuffer(points, np.float32).reshape(-1, WIDTH))
    grown = context.broadcast(world)
    names = rests.columns
    at = names.index("ids")

    def dealt(batches):
        for batch in batches:
            raws, leaves = batch.column(at).to_pylist(), [np.zeros(0, np.int64)]
            for i in range(0, len(raws), 4096):
                leaves.append(grown.value.leaves(grown.value.directions(raws[i : i + 4096], kind)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(leaves))], [*names, "leaf"]
            )

    schema = ", ".join(f"{c} {t}" for c, t in rests.dtypes) + ", leaf bigint"
    placed = tables.written(rests.mapInArrow(dealt, schema), "packing-rests")
    # One row per pivot.
    counts = sorted(tuple(r) for r in placed.groupBy("leaf").count().collect())
    rows, shards, room = [], 0, 0
    for leaf, n in counts:
        if n > room:
            parts = -(-n // shard)
            first, shards, room = shards, shards + parts, 0 if parts > 1 else shard
        else:
            first, parts = shards - 1, 1
        room -= n
        rows.append((leaf, first, parts))
    columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)]
    shard_of = rests.sparkSession.createDataFrame(
        pa.Table.from_arrays(columns, ["leaf", "first", "parts"])
    )
    return placed.join(F.broadcast(shard_of), "leaf").withColumn(
        "shard", F.col("first") + F.pmod(F.xxhash64("rest"), F.col("parts"))
    ).drop("leaf", "first", "parts")


class _Shard:
    """Rests of one shard: index, unused rests, and the windows made of them."""

    def __init__(self, ids, window, inverse, mean):
        self.ids, self.window = ids, window
        held = [np.unique(x, return_counts=True) for x in ids]
        self.terms = [t for t, _ in held]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        sizes = np.fromiter(map(len, self.terms), np.int64, len(ids))
        term = np.concatenate(self.terms)
        doc = np.repeat(np.arange(len(ids)), sizes)
        often = np.concatenate([n for _, n in held])
        norm = K1 * (1 - B + B * lengths[doc] / mean)
        weight = inverse[term] * often * (K1 + 1) / (often + norm)
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order].astype(np.float32)
        term = term[order]
        self.begin = np.searchsorted(term, np.arange(len(inverse) + 1))
        # Weights of common ids as plain rows, which add up faster than lists.
        common = np.flatnonzero(np.diff(self.begin) > max(COMMON * len(ids), 8))
        self.row = np.full(len(inverse), -1)
        self.row[common] = np.arange(len(common))
        self.plain = np.zeros((len(common), len(ids)), np.float32)
        some = self.row[term] >= 0
        self.plain[self.row[term[some]], self.doc[some]] = self.weight[some]
        self.unused = np.ones(len(ids), bool)

    def neighbours(self, seed, room):
        """Unused rests that share a token, best first, enough to fill ``room``."""
        rows = self.row[self.terms[seed]]
        rare = self.terms[seed][rows < 0]
        a, b = self.begin[rare], self.begin[rare + 1]
        sizes = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        at += np.arange(len(at))
        score = np.bincount(self.doc[at], self.weight[at], minlength=len(self.ids))
        score = score + self.plain[rows[rows >= 0]].sum(axis=0)
        found = np.flatnonzero(self.unused & (score > 0))
        # Stable: rests of one score follow in the order of their numbers.
        for i in found[np.argsort(-score[found], kind="stable")]:
            yield i
            room -= len(self.ids[i])
            if room <= 0:
                return

    def windows(self):
        """Lists of (rest, first id, number of ids), one list per window."""
        queue, left = list(range(len(self.ids)))[::-1], {}
        window, room = [], self.window

        def put(i):
            nonlocal window, room
            start, self.unused[i] = left.pop(i, 0), False
            n = len(self.ids[i]) - start
            taken = min(n, room)
            window.append((i, start, taken))
            room -= taken
            if taken < n:
                left[i] = start + taken
                queue.append(i)
            if room == 0:
                full, window, room = window, [], self.window
                return full
            return None

        while queue:
            seed = queue.pop()
            if not self.unused[seed] and seed not in left:
                continue
            if (full := put(seed)) is not None:
                yield full
                continue
            for i in self.neighbours(seed, room):
                if (full := put(i)) is not None:
                    yield full
                    break
        if window:
            yield window


def pack(docs, path, window=1024, end=0, shard=SHARD):
    """One row per piece: where it stands in its document and in its sequence.

    ``ids`` are its token ids, little-endian (see ``bpe.compact``).
    """
    cut = tables.written(pieces(docs, path, window, end), "packing-pieces")
    rests = cut.where("rest is not null")
    size, kind = bpe.codec(path).size, bpe.compact(path)
    n, tokens = rests.agg(F.count("rest"), F.sum("length")).first()
    # A table of one number per id of the vocabulary, whatever the corpus.
    often = np.zeros(size, np.int64)
    for row in frequencies(rests, size, kind).toLocalIterator():
        often[row.id] = row.n
    inverse = np.log1p((n - often + 0.5) / (often + 0.5)).astype(np.float32)
    mean = (tokens or 0) / max(n, 1)
    given = docs.sparkSession.sparkContext.broadcast((inverse, mean))
    if n > shard:
        dealt = _placed(rests, _Map(inverse, often, mean), kind, shard)
    else:
        dealt = rests.withColumn("shard", F.lit(0).cast("bigint"))

    names = [f.split()[0] for f in _PACKED.split(", ")]
    kinds = [*[pa.int64()] * 7, pa.binary()]

    def fill(table):
        table = table.sort_by("rest")
        number = table.column("shard")[0].as_py() << 32
        columns = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        rests, rows = list(zip(*columns)), []
        ids = [np.frombuffer(r[-1], kind) for r in rests]
        for k, parts in enumerate(_Shard(ids, window, *given.value).windows()):
            offset = 0
            for i, first, taken in parts:
                doc, start, total, _ = rests[i]
                part = ids[i][first : first + taken]
                rows.append((doc, start + first, taken, zlib.crc32(part.astype("<u4")), total,
                             number + k, offset, part.tobytes()))
                offset += taken
        columns = zip(*rows)
        return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    rest_pieces = dealt.groupBy("shard").applyInArrow(fill, _PACKED)
    whole = cut.where("rest is null").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.lit(0).cast("bigint").alias("offset"), "ids",
    )
    return whole.unionByName(rest_pieces)

