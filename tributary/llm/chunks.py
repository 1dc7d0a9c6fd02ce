"""Overlapping chunks of bytes that cover whole texts, and bounded samples of them."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.llm import tables, words

SIZE, OVERLAP = 512, 32


def cut(data, offsets):
    """Chunks of all texts (rows of SIZE bytes, zero-filled), and each text's first.

    An empty text has one chunk, of zeros.
    """
    lengths = np.diff(offsets)
    counts = np.maximum(-(-(lengths - OVERLAP) // (SIZE - OVERLAP)), 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(lengths)), counts)
    begin = (np.arange(first[-1]) - first[:-1][owner]) * (SIZE - OVERLAP)
    padded = np.concatenate([data, np.zeros(SIZE, np.uint8)])
    at = (offsets[:-1][owner] + begin)[:, None] + np.arange(SIZE)
    rows = padded[np.minimum(at, len(padded) - 1)]
    rows[begin[:, None] + np.arange(SIZE) >= lengths[owner][:, None]] = 0
    return rows, first


def sample(labelled, most, label="label"):
    """At most ``most`` chunks (bytes) with their labels, the same in every run.

    ``labelled`` has ``doc_id``, ``text`` and ``label`` (INT).  Chunks are picked
    over all texts, evenly, by a hash of document and place; few chunks are all
    taken.  The bound is the parameter ``most``: 512 bytes each.
    """

    def chunked(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            for i, j in words.slices(offsets):
                rows, first = cut(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                n = np.diff(first)
                part = batch.slice(i, j - i)
                at = pa.array(np.repeat(np.arange(j - i), n))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column(label).take(at),
                     pa.array(np.arange(first[-1]) - np.repeat(first[:-1], n)),
                     pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["doc_id", "label", "place", "chunk"],
                )

    made = labelled.select("doc_id", "text", label).mapInArrow(
        chunked, "doc_id bigint, label int, place bigint, chunk binary"
    )
    order = F.xxhash64("doc_id", "place")
    # Little more than the sample is sorted, however many chunks there are.
    size = F.greatest(F.ceil((F.octet_length("text") - OVERLAP) / (SIZE - OVERLAP)), F.lit(1))
    share = 1.3 * most / (labelled.agg(F.sum(size)).first()[0] or 1)
    some = made.withColumn("o", order).where((F.shiftrightunsigned("o", 1) / 2.0**63) < share)
    # Rows of one id may differ in text.
    picked = some.orderBy("o", "doc_id", "place", F.xxhash64("chunk")).limit(most)
    rows = tables.written(picked.select("chunk", "label"), "chunk-sample").collect()
    held = np.frombuffer(b"".join(bytes(r.chunk) for r in rows), np.uint8).reshape(-1, SIZE)
    return held, np.array([r.label for r in rows], np.int64)
