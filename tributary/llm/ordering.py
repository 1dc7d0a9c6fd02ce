"""Training-order materialisation: shuffled sequences in fixed-stride shards.

The texts of a task are one stream of ids, each text closed by ``end``, cut into
sequences of ``length`` ids; the last one of a task is padded.  Sequences are
numbered through (tasks in order), and a keyed Feistel network over the next even
number of bits, walked until it falls below their number, permutes the numbers to
global slots.  Slots ``[k * per_shard, (k + 1) * per_shard)`` are shard ``k``, one
file of ``stride`` bytes per slot, in order: slot ``s`` is found by arithmetic, and
reading can go on anywhere.

Two passes over the texts: sequences per task are counted, then made, sent to their
shard compressed, and written under a name of the attempt that is moved into place,
so a task that runs twice leaves one file.  A shard is bounded by ``per_shard``.

Cases: a null or empty text is its ``end`` alone.  Repeated rows and rows without
id are texts like others.  An empty table gives no shards and no rows.  Only id and
text are looked at.
"""

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from tributary.llm import bpe, tables
from tributary.sources import staging

_ROUNDS = 6
_INDEX = (
    "slot bigint, shard bigint, position bigint, number bigint, doc_id bigint,"
    " doc_start bigint, n_tokens bigint, ids_crc32 bigint"
)


def _round(half, key, bits):
    x = (half + key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x & ((np.uint64(1) << bits) - np.uint64(1))


def permuted(numbers, n, key):
    """Slots of ``numbers``: a permutation of 0..n-1 that ``key`` picks."""
    bits = np.uint64(max(1, -(-int(n - 1).bit_length() // 2)))
    keys = np.random.default_rng(key).integers(1, 2**63, _ROUNDS, dtype=np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)

    def once(x):
        left, right = x >> bits, x & low
        for k in keys:
            left, right = right, left ^ _round(right, k, bits)
        return (left << bits) | right

    slots = once(np.asarray(numbers, np.uint64))
    while (out := slots >= np.uint64(n)).any():
        slots[out] = once(slots[out])
    return slots.astype(np.int64)


def _sequences(batches, path, length, end):
    """(ids as bytes, document at the first id, its ids before, ids) per sequence."""
    known, kind = bpe.codec(path), bpe.compact(path)
    close = np.array([end], kind).tobytes()
    wide = len(close)
    held, begins, at = bytearray(), [], 0  # texts begun in what is held
    stride = length * wide
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, j in bpe.batches(texts):
            for doc, raw in zip(ids[i:j], known.encode(texts[i:j])):
                begins.append((at + len(held), doc))
                held += np.frombuffer(raw, "<u4").astype(kind).tobytes() + close
                cut = 0
                while len(held) - cut >= stride:
                    begins = _from(begins, at)
                    yield bytes(held[cut : cut + stride]), begins[0][1], (at - begins[0][0]) // wide, length
                    cut += stride
                    at += stride
                del held[:cut]
    if held:
        begins, n = _from(begins, at), len(held) // wide
        yield bytes(held) + close * (length - n), begins[0][1], (at - begins[0][0]) // wide, n


def _from(begins, at):
    """Drop texts that end before ``at``; the first one left holds that place."""
    k = 0
    while k + 1 < len(begins) and begins[k + 1][0] <= at:
        k += 1
    return begins[k:] if k else begins


def materialise(docs, path, length=1024, per_shard=8192, key=1, end=50256, folder=None):
    """Write all shards and the manifest; one row per sequence, with its slot."""
    docs = tables.documents(docs)
    folder = folder or staging.shared_folder(docs.sparkSession, "training-order")

    def count(batches):
        n, total = 0, 0
        for raw, *_ in _sequences(batches, path, length, end):
            n, total = n + 1, zlib.crc32(raw, total)
        columns = [[TaskContext.get().partitionId()], [n], [total]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["task", "n", "total"])

    # One row per task of the scan, not per document.
    counts = docs.mapInArrow(count, "task bigint, n bigint, total bigint").collect()
    first, n = {}, 0
    for row in sorted(counts):
        first[row.task], n = (n, row.n, row.total), n + row.n

    def deal(batches):
        task = TaskContext.get().partitionId()
        begin, expected, checksum = first[task]
        made, total, rows = 0, 0, []

        def flush():
            raws, docs, starts, sizes = zip(*rows)
            numbers = np.arange(begin + made - len(rows), begin + made)
            slots = permuted(numbers, n, key)
            columns = [
                pa.array(slots), pa.array(slots // per_shard), pa.array(numbers),
                *(pa.array(list(c), pa.int64()) for c in (docs, starts, sizes)),
                pa.array([pa.compress(r, "zstd", asbytes=True) for r in raws], pa.binary()),
            ]
            names = ["slot", "shard", "number", "doc_id", "doc_start", "n_tokens", "ids"]
            return pa.RecordBatch.from_arrays(columns, names)

        for row in _sequences(batches, path, length, end):
            made, total = made + 1, zlib.crc32(row[0], total)
            if made > expected:
                break
            rows.append(row)
            if len(rows) == 2048:
                yield flush()
                rows.clear()
        if (made, total) != (expected, checksum):
            raise ValueError("the documents were dealt otherwise when read again; store them first")
        if rows:
            yield flush()

    wide = np.dtype(bpe.compact(path)).itemsize
    stride = length * wide

    def write(table):
        table = table.sort_by("slot")
        raws = [pa.decompress(r, stride, "zstd", asbytes=True) for r in table.column("ids").to_pylist()]
        shard, slots = table.column("shard")[0].as_py(), table.column("slot").to_numpy()
        begin = shard * per_shard
        assert (slots == np.arange(begin, min(begin + per_shard, n))).all()
        _put(f"{folder}/{_name(shard)}", b"".join(raws))
        return pa.table({
            "slot": table.column("slot"),
            "shard": table.column("shard"),
            "position": pa.array((slots - begin) * stride),
            **{c: table.column(c) for c in ("number", "doc_id", "doc_start", "n_tokens")},
            "ids_crc32": pa.array([zlib.crc32(r) for r in raws], pa.int64()),
        })

    manifest = {"sequences": n, "length": length, "per_shard": per_shard, "bytes": wide, "key": key}
    _put(f"{folder}/manifest.json", json.dumps(manifest).encode())
    dealt = docs.mapInArrow(
        deal,
        "slot bigint, shard bigint, number bigint, doc_id bigint, doc_start bigint,"
        " n_tokens bigint, ids binary",
    )
    # The index is stored with the shards, so that asking for it does not write again.
    index = dealt.groupBy("shard").applyInArrow(write, _INDEX)
    index.write.parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def _name(shard):
    return f"shard-{shard:08d}.bin"


def _put(path, raw):
    """Write a file under a name of its own, then move it into place."""
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    own = f"{place}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(raw)
    store.move(own, place)


def read(spark, folder, first=0, last=None):
    """Sequences of slots ``first`` up to ``last`` (exclusive), from their shards."""
    store, place = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{place}/manifest.json") as file:
        held = json.loads(file.read())
    n, per = held["sequences"], held["per_shard"]
    last = n if last is None else min(last, n)
    stride, kind = held["length"] * held["bytes"], f"<u{held['bytes']}"

    def cut(batches):
        for batch in batches:
            shards, slots, ids = batch.column("shard").to_pylist(), [], []
            for shard in shards:
                source, at = fs.FileSystem.from_uri(f"{folder}/{_name(shard)}")
                a, b = max(first, shard * per), min(last, (shard + 1) * per)
                with source.open_input_file(at) as file:
                    file.seek((a - shard * per) * stride)
                    raw = file.read((b - a) * stride)
                slots += range(a, b)
                ids += np.frombuffer(raw, kind).astype(np.int32).reshape(-1, held["length"]).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["slot", "ids"]
            )

    shards = spark.range(first // per, -(-last // per) if last > first else first // per)
    shards = shards.select(F.col("id").alias("shard"))
    return shards.mapInArrow(cut, "slot bigint, ids array<int>")
