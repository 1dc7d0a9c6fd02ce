"""Approximate nearest neighbours: a robust-pruned directed graph per shard.

Nearness is the inner product.  For building, each vector gets one more component,
``sqrt(M**2 - |v|**2)`` with ``M`` the largest norm, so that the largest inner
product with a query is the smallest distance to it.  Distinct vectors are dealt to
shards of about ``SHARD`` by a hash.  A shard's graph grows in batches that double:
greedy searches from the entry point propose neighbours, relaxed pruning
keeps a candidate unless one kept before is ``ALPHA`` times nearer to it than the
point itself is, and edges back are pruned alike.  Each query walks each
shard's graph with a beam; blocks of ``BLOCK`` queries meet a shard in a task of
their own.  The shards' results are merged, and scored in double precision.

Equal vectors are one node with its smallest ids, one more than neighbours asked
for, so a result never lacks one: however many copies there are, a query
can list no more of them.

Cases: rows whose vector is null, empty, all zero or has a null, NaN or infinite
component, and rows without id, take no part.  The same id with the same vector is
one row; with another vector it is another candidate.  Vectors of different lengths
never meet.  Queries without candidates give no rows, and an empty table none.
Other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tributary.llm import tables

SHARD, BLOCK = 8192, 4096
DEGREE, BEAM, ALPHA = 32, 64, 1.2
#: Width of the beam of a query.
SEARCH = 128


def usable(df, id_column="vec_id", vector="embedding"):
    """Ids and vectors that take part, repeated rows once."""
    v = F.col(f"`{vector}`").cast("array<float>")
    x = F.col("v")
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0))
        .where(sound & F.exists(x, lambda c: c != 0))
        # Minus zero is zero, so that equal vectors have equal components.
        .select("vec_id", F.transform(x, lambda c: c + F.lit(0.0).cast("float")).alias("v"))
        .distinct()
    )


class Graph:
    """A pruned graph over the rows of a matrix, and searches on it."""

    def __init__(self, points, seed=1):
        self.points = points.astype(np.float32)
        self.square = (self.points**2).sum(axis=1)
        n = len(points)
        self.edges = np.full((n, DEGREE), -1, np.int32)
        middle = self.points.mean(axis=0)
        self.entry = int(np.argmin(self.square - 2 * self.points @ middle))
        rng = np.random.default_rng(seed)
        order = rng.permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]])
        done = 1
        while done < n:
            step = order[done : done + min(max(done, 1), 1024)]
            self._insert(step)
            done += len(step)
        # A second pass over a finished graph mends what early points missed.
        for i in range(0, n, 1024):
            self._insert(order[i : i + 1024])

    def _distance(self, queries, squares, ids):
        """Squared distances of each query to its own row of ids; -1 is far."""
        near = np.einsum("bd,bkd->bk", queries, self.points[ids])
        distance = squares[:, None] + self.square[ids] - 2 * near
        return np.where(ids >= 0, np.maximum(distance, 0), np.inf).astype(np.float32)

    def search(self, queries, beam):
        """Greedy walks of all queries at once: ids and distances, nearest first.

        In each step every walk opens its nearest points not opened yet.
        """
        b, n = len(queries), len(self.points)
        squares = (queries**2).sum(axis=1)
        ids = np.full((b, beam), -1, np.int32)
        far = np.full((b, beam), np.inf, np.float32)
        opened = np.zeros((b, beam), bool)
        ids[:, 0] = self.entry
        far[:, 0] = self._distance(queries, squares, ids[:, :1])[:, 0]
        seen = np.zeros((b, n), bool)
        seen[:, self.entry] = True
        active = np.arange(b)
        width = 4
        while len(active):
            waiting = np.where(opened[active] | (ids[active] < 0), np.inf, far[active])
            pick = np.argpartition(waiting, width, axis=1)[:, :width]
            some = np.isfinite(np.take_along_axis(waiting, pick, axis=1))
            going = some.any(axis=1)
            active, pick, some = active[going], pick[going], some[going]
            if not len(active):
                break
            rows = active[:, None]
            from_ = np.where(some, ids[rows, pick], -1)
            opened[rows, pick] |= some
            next_ = np.where(from_[:, :, None] >= 0, self.edges[from_], -1).reshape(len(active), -1)
            new = (next_ >= 0) & ~seen[rows, next_]
            next_ = np.where(new, next_, -1)
            # One of several equal ones counts.
            next_ = np.sort(next_, axis=1)
            next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = -1
            r, c = np.nonzero(next_ >= 0)
            seen[active[r], next_[r, c]] = True
            # Columns that no walk uses are left out.
            used = int((next_ >= 0).sum(axis=1).max())
            if used == 0:
                continue
            next_ = -np.sort(-next_, axis=1)[:, :used]
            distance = self._distance(queries[active], squares[active], next_)
            all_ids = np.concatenate([ids[active], next_], axis=1)
            all_far = np.concatenate([far[active], distance], axis=1)
            all_open = np.concatenate([opened[active], np.zeros(next_.shape, bool)], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, axis=1)
            far[active] = np.take_along_axis(all_far, best, axis=1)
            opened[active] = np.take_along_axis(all_open, best, axis=1)
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)

    def _pruned(self, points, ids, far):
        """For each point DEGREE diverse ones of its candidates, nearest first."""
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, axis=1), np.take_along_axis(far, order, axis=1)
        open_ = (ids >= 0) & (ids != points[:, None]) & np.isfinite(far)
        kept = np.full((len(points), DEGREE), -1, np.int32)
        vectors = self.points[ids]
        rows = np.arange(len(points))
        for k in range(DEGREE):
            first = open_.argmax(axis=1)
            live = open_[rows, first]
            if not live.any():
                break
            kept[live, k] = ids[rows, first][live]
            chosen = ids[rows, first]
            between = (
                self.square[ids] + self.square[chosen][:, None]
                - 2 * np.einsum("bkd,bd->bk", vectors, self.points[chosen])
            )
            open_ &= ALPHA**2 * between > far
            open_[rows, first] = False
            open_ &= ids != chosen[:, None]
        return kept

    def _insert(self, step):
        ids, far = self.search(self.points[step], BEAM)
        old = self.edges[step]
        ids = np.concatenate([ids, old], axis=1)
        far = np.concatenate([far, self._distance(self.points[step], self.square[step], old)], axis=1)
        self.edges[step] = self._pruned(step, ids, far)
        # Edges back; points that get too many are pruned again.
        source = np.repeat(step, DEGREE)
        target = self.edges[step].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        points, first, counts = np.unique(target, return_index=True, return_counts=True)
        if not len(points):
            return
        for low, high in ((0, 32), (32, 128), (128, len(source) + 1)):
            some = (counts > low) & (counts <= high)
            if not some.any():
                continue
            p, f, c = points[some], first[some], counts[some]
            wide = int(c.max())
            for i in range(0, len(p), 4096 if wide <= 128 else 64):
                j = slice(i, i + (4096 if wide <= 128 else 64))
                at = f[j, None] + np.arange(wide)
                back = np.where(np.arange(wide) < c[j, None], source[np.minimum(at, len(source) - 1)], -1)
                both = np.concatenate([self.edges[p[j]], back], axis=1).astype(np.int32)
                far = self._distance(self.points[p[j]], self.square[p[j]], both)
                self.edges[p[j]] = self._pruned(p[j], both, far)


def _matrix(column):
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def index(vectors, largest):
    """Nodes of every shard: shard, node, vector and edges."""

    def build(table):
        base = _matrix(table.column("v")).astype(np.float64)
        extra = np.sqrt(np.maximum(largest - (base**2).sum(axis=1), 0))
        graph = Graph(np.column_stack([base, extra]))
        return pa.table({
            "shard": table.column("shard"),
            "node": pa.array(np.arange(len(base)), pa.int64()),
            "entry": pa.array(np.arange(len(base)) == graph.entry),
            "key": table.column("key"),
            "v": table.column("v"),
            "edges": pa.array(list(graph.edges), pa.list_(pa.int32())),
        })

    return vectors.groupBy("shard").applyInArrow(
        build,
        "shard bigint, node bigint, entry boolean, key string, v array<float>, edges array<int>",
    )


def nearest(df, queries, k=20, id_column="vec_id", vector="embedding", search=SEARCH):
    """The ``k`` nearest found for each query, a condition on the id ``vec_id``."""
    rows = tables.written(
        usable(df, id_column, vector).withColumn("key", F.sha2(F.to_json("v"), 256)), "ann-rows"
    )
    # Of equal vectors the k + 1 smallest ids; a query can be one of them.
    ranked = rows.select("key", "vec_id").withColumn(
        "r", F.row_number().over(W.partitionBy("key").orderBy("vec_id"))
    )
    members = ranked.where(F.col("r") <= k + 1).select("key", "vec_id")
    distinct = rows.groupBy("key").agg(F.first("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    n, largest = rows.agg(F.count(F.lit(1)), F.max(square)).first()
    shards = max(1, -(-n // SHARD))
    # Vectors of different lengths are in different shards.
    shard = F.size("v").cast("bigint") * (1 << 32) + F.pmod(F.xxhash64("key"), F.lit(shards))
    nodes = tables.written(index(distinct.withColumn("shard", shard), largest or 0.0), "ann-index")

    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), "v")
    blocks = max(1, -(-asked.count() // BLOCK))
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    places = nodes.select(F.col("shard").alias("place")).distinct()
    asked = asked.withColumns({"part": block, "length": F.size("v")}).join(
        places.withColumn("length", F.shiftright("place", 32).cast("int")), "length"
    )
    copies = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")))

    def walk(graph, questions):
        made = {"query_id": [], "key": [], "score": []}
        if graph.num_rows and questions.num_rows:
            graph = graph.sort_by("node")
            base, q = _matrix(graph.column("v")), _matrix(questions.column("v"))
            extra = np.sqrt(np.maximum(largest - (base.astype(np.float64) ** 2).sum(axis=1), 0))
            points = np.column_stack([base, extra]).astype(np.float32)
            held = Graph.__new__(Graph)
            held.points, held.square = points, (points**2).sum(axis=1)
            held.edges = _matrix(graph.column("edges"))
            held.entry = int(np.flatnonzero(graph.column("entry").to_numpy(zero_copy_only=False))[0])
            keys, ids = np.array(graph.column("key").to_pylist()), questions.column("query_id").to_numpy()
            for i in range(0, len(q), 512):
                part = np.column_stack([q[i : i + 512], np.zeros(len(q[i : i + 512]), np.float32)])
                found, _ = held.search(part.astype(np.float32), max(search, 2 * k))
                score = np.einsum("bd,bkd->bk", part[:, :-1].astype(np.float64), base[found].astype(np.float64))
                score[found < 0] = -np.inf
                best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                good = np.isfinite(np.take_along_axis(score, best, axis=1))
                made["query_id"].append(np.repeat(ids[i : i + 512], best.shape[1])[good.ravel()])
                made["key"].append(keys[np.take_along_axis(found, best, axis=1)][good])
                made["score"].append(np.take_along_axis(score, best, axis=1)[good])
        kinds = {"query_id": pa.int64(), "key": pa.string(), "score": pa.float64()}
        return pa.table({c: pa.array(np.concatenate(x) if x else [], kinds[c]) for c, x in made.items()})

    hits = (
        copies.groupBy("shard", "block")
        .cogroup(asked.groupBy("place", "part"))
        .applyInArrow(walk, "query_id bigint, key string, score double")
    )
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "key")
    hits = hits.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    listed = hits.join(members, "key").where("vec_id <> query_id")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        listed.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
