"""A quality classifier: a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all of it.  A byte is its eight
bits and a ninth value, how near before it the same four bytes stood.  Learned
filters of ``WIDTH`` bytes run over each chunk; the maximum and the mean of each
filter feed a small dense layer that gives the chunk's logit.  The document's
probability is the logistic function of the mean of its chunks' logits.

The network is fitted by Adam on a bounded sample of chunks of labelled texts
(``SAMPLE``, of as many labelled ids at most), with both labels of equal weight, and its weights (some 20 kB) are
broadcast.  Fitting is repeatable: fixed seeds, a sample by hash.

Cases: a null or empty text is one chunk of zeros and gets a score.  Labels that
are null, and rows whose text is null, are not learned from; with no or one label
alone every score is the share of label 1 (0.5 without labels).  Repeated rows are
scored each.  An empty table gives no rows.  Other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.llm import chunks, tables, words

#: Chunks that the network is fitted on, at most.
SAMPLE = 12_000
WIDTH, STRIDE, FILTERS, DENSE = 8, 4, 32, 16
EPOCHS, BATCH, RATE = 10, 128, 3e-3


def _bits(rows):
    """Each byte as nine numbers: its bits, and how near the same four stood."""
    n, size = rows.shape
    wide = rows.astype(np.uint32)
    grams = wide[:, :-3] | wide[:, 1:-2] << 8 | wide[:, 2:-1] << 16 | wide[:, 3:] << 24
    # Hash and place in one number: a plain sort puts equal grams in order.
    keys = (grams * np.uint32(2654435761) >> np.uint32(9)) << np.uint32(9)
    keys |= np.arange(size - 3, dtype=np.uint32)
    keys.sort(axis=1)
    same = (keys[:, 1:] >> 9) == (keys[:, :-1] >> 9)
    place = keys & np.uint32(511)
    near = np.where(same, np.exp2((place[:, :-1] - place[:, 1:].astype(np.float32)) / 32), 0)
    made = np.zeros((n, size, 9), np.float32)
    made[:, :, :8] = np.unpackbits(rows[:, :, None], axis=2)
    np.put_along_axis(made[:, :, 8], place[:, 1:].astype(np.int64), near.astype(np.float32), axis=1)
    made[:, :, 8][rows == 0] = 0
    return made


def _frames(rows):
    bits = _bits(rows)
    view = np.lib.stride_tricks.sliding_window_view(bits, WIDTH, axis=1)[:, ::STRIDE]
    # (chunk, frame, channel, offset) as rows of one matrix.
    return view.reshape(len(rows), view.shape[1], -1)


class Network:
    """Weights, the forward pass, and fitting."""

    def __init__(self, seed=8):
        rng = np.random.default_rng(seed)
        scale = {"w": 9 * WIDTH, "d": 2 * FILTERS, "o": DENSE}
        shape = {"w": (9 * WIDTH, FILTERS), "d": (2 * FILTERS, DENSE), "o": (DENSE, 1)}
        self.p = {
            k: rng.normal(0, (2 / scale[k]) ** 0.5, s).astype(np.float32) for k, s in shape.items()
        }
        self.p |= {f"{k}b": np.zeros(s[1], np.float32) for k, s in shape.items()}
        self.constant = None

    def _pools(self, frames):
        out = np.maximum(frames @ self.p["w"] + self.p["wb"], 0)
        top = out.argmax(axis=1)
        best = np.take_along_axis(out, top[:, None], axis=1)[:, 0]
        return out, top, np.concatenate([best, out.mean(axis=1)], axis=1)

    def logits(self, rows):
        made = []
        for i in range(0, len(rows), BATCH):
            pools = self._pools(_frames(rows[i : i + BATCH]))[2]
            hidden = np.maximum(pools @ self.p["d"] + self.p["db"], 0)
            made.append((hidden @ self.p["o"] + self.p["ob"])[:, 0])
        return np.concatenate(made) if made else np.zeros(0, np.float32)

    def fit(self, rows, labels, seed=8):
        share = labels.mean() if len(labels) else 0.5
        if len(set(labels.tolist())) < 2:
            self.constant = float(share)
            return self
        rng = np.random.default_rng(seed)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        t = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                grads, t = self._gradients(rows[some], labels[some], weight[some]), t + 1
                for k, g in grads.items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    fair = np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8
                    self.p[k] -= RATE * m[k] / (1 - 0.9**t) / fair
        return self

    def _gradients(self, rows, labels, weight):
        frames = _frames(rows)
        out, top, pools = self._pools(frames)
        before = pools @ self.p["d"] + self.p["db"]
        hidden = np.maximum(before, 0)
        logit = (hidden @ self.p["o"] + self.p["ob"])[:, 0]
        slope = (weight * (1 / (1 + np.exp(-logit)) - labels) / len(rows)).astype(np.float32)[:, None]
        back = (slope @ self.p["o"].T) * (before > 0)
        pooled = back @ self.p["d"].T
        flow = np.repeat(pooled[:, None, FILTERS:] / out.shape[1], out.shape[1], axis=1)
        at = np.take_along_axis(flow, top[:, None], axis=1) + pooled[:, None, :FILTERS]
        np.put_along_axis(flow, top[:, None], at, axis=1)
        flow *= out > 0
        flat = flow.reshape(-1, FILTERS)
        return {
            "w": frames.reshape(-1, frames.shape[2]).T @ flat, "wb": flat.sum(axis=0),
            "d": pools.T @ back, "db": back.sum(axis=0),
            "o": hidden.T @ slope, "ob": slope.sum(axis=0),
        }


def fit(labelled, most=SAMPLE):
    """A network fitted on a sample of ``labelled`` (doc_id, text, label 0 or 1)."""
    known = labelled.where("label in (0, 1) and text is not null")
    return Network().fit(*chunks.sample(known, most))


def score(docs, network):
    """Per row of ``docs``: doc_id, score (0 to 1)."""
    docs = tables.documents(docs)
    held = docs.sparkSession.sparkContext.broadcast(network)

    def scored(batches):
        model = held.value
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            made = []
            for i, j in words.slices(offsets, 1 << 18):
                rows, first = chunks.cut(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                if model.constant is not None:
                    made.append(np.full(j - i, model.constant))
                    continue
                sums = np.add.reduceat(model.logits(rows).astype(np.float64), first[:-1])
                made.append(1 / (1 + np.exp(-np.clip(sums / np.diff(first), -50, 50))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(made) if made else [], pa.float64())],
                ["doc_id", "score"],
            )

    return docs.mapInArrow(scored, "doc_id bigint, score double")


def trained(docs, labels, learn):
    """The network learnt from rows of ``docs`` with a label where ``learn`` holds."""
    wanted = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("label")
    ).where(learn & F.col("label").isNotNull())
    wanted = wanted.where("label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    # A chunk an id at least, so as many ids as chunks are enough; texts are not moved.
    order = F.xxhash64(F.lit("quality"), "doc_id")
    share = 1.2 * SAMPLE / max(wanted.count(), 1)
    some = wanted.withColumn("o", order).where((F.shiftrightunsigned("o", 1) / 2.0**63) < share)
    ids = tables.written(some.orderBy("o", "doc_id").limit(SAMPLE).drop("o"), "classifier-ids")
    return fit(tables.documents(docs).join(F.broadcast(ids), "doc_id"))
