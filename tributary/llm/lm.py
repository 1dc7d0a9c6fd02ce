"""Language-model scores by a weighted backoff automaton over words.

States are the empty history, the start of a text, and every word seen in
training; an arc leads from a state by a word to that word's state.  With ``p``
the unigram probability (add-one, one more type for all unseen words), state
``u`` has

* for every training bigram ``u w`` an arc of weight
  ``log10((c(uw) + k p(w)) / (c(u) + k))``,
* one failure arc to the empty history, of weight ``log10(k / (c(u) + k))``, where
  ``w`` is then read with weight ``log10 p(w)``.

So the weights out of a state sum to one.  A text is read once from left to
right, closed by an end token; a word never seen leads to the empty history.

All n-grams of all training texts count.  Texts are taken in blocks of about
``BLOCK`` bytes; each block asks for the totals of its distinct n-grams with one
packed blob per bucket of the key space, a bucket sums what the blocks hold (a key
comes once per block, however common it is) and answers only what the block
cannot know itself.  Texts move once, to meet the answers.

Cases: a null or empty text is the end token alone.  Repeated rows count and are
scored each for itself.  Rows without id belong to no fold and are trained on.  An
empty table gives no rows.  Other columns are not looked at.
"""

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import functions as F

from tributary.llm import tables, words

#: Bytes of text in a block, and about how many n-grams in a bucket.
BLOCK = 8 << 20
BUCKET = 2_000_000

_END, _START = np.uint64(0xE17B1C0FFEE0D0E1), np.uint64(0x5A17B1C0FFEE0D05)
_LEFT = np.uint64(0xD6E8FEB86659FD93)
_REQUEST = "block bigint, bucket int, n bigint, keys binary, counts binary"


def _unigrams(tokens):
    return tokens << np.uint64(1)


def _bigrams(left, right):
    return (words.mix(left * _LEFT + right) << np.uint64(1)) | np.uint64(1)


def _tokens(data, offsets):
    """Tokens of all texts, each closed by the end, and where texts begin."""
    hashes, bounds = words.word_hashes(data, offsets)
    ends = bounds[1:]
    tokens = np.insert(hashes, ends, _END)
    return tokens, bounds + np.arange(len(bounds))


def _histories(tokens, bounds):
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = _START
    return before


def _blocks(batches):
    """(block, batch) with each block about BLOCK bytes of consecutive texts."""
    task, k, held = TaskContext.get().partitionId() << 24, 0, 0
    for batch in batches:
        _, offsets = words.utf8(batch.column("text"))
        for i, j in words.slices(offsets, BLOCK // 4):
            size = int(offsets[j] - offsets[i])
            if held and held + size > BLOCK:
                k, held = k + 1, 0
            held += size
            yield task + k, batch.slice(i, j - i)


def _counted(batches):
    """Sorted keys of the n-grams in ``batches`` and how often training has them."""
    keys, counts = [], []
    for batch in batches:
        data, offsets = words.utf8(batch.column("text"))
        train = ~np.array(batch.column("held_out").to_pylist(), bool)
        for i, j in words.slices(offsets):
            tokens, bounds = _tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            before = _histories(tokens, bounds)
            seen = np.repeat(train[i:j], np.diff(bounds))
            starts = np.full(j - i, _START)
            for key, flag in (
                (_unigrams(tokens), seen),
                (_unigrams(starts), train[i:j]),
                (_bigrams(before, tokens), seen),
            ):
                unique, at = np.unique(key, return_inverse=True)
                keys.append(unique)
                counts.append(np.bincount(at, flag, len(unique)).astype(np.int64))
    return _summed(keys, counts)


def _summed(keys, counts):
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    if len(begins) == 0:
        return keys, counts
    return keys[begins], np.add.reduceat(counts, begins)


def _planes(values):
    """Bytes of numbers, all highest bytes together, so that zeros compress."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def _values(raw, n, kind):
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(-1, n).T).view(kind)[:, 0]


def _pack(keys, counts):
    steps = np.diff(keys, prepend=np.uint64(0)) if len(keys) else keys
    return len(keys), _planes(steps), _planes(counts.astype(np.uint64))


def _unpack(n, keys, counts):
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    steps, counts = _values(keys, n, np.uint64), _values(counts, n, np.uint64)
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def _requests(docs, buckets):
    """What each block asks each bucket: its n-grams, and its own training counts."""

    def ask(batches):
        def asked(block, held):
            keys, counts = _counted(held)
            edge = np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)
            cuts = [0, *np.searchsorted(keys, edge.astype(np.uint64)), len(keys)]
            rows = [(block, -1, _checksum(held), b"", b"")]
            for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if j > i:
                    rows.append((block, b, *_pack(keys[i:j], counts[i:j])))
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            names = ["block", "bucket", "n", "keys", "counts"]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)], names
            )

        current, held = None, []
        for block, batch in _blocks(batches):
            if held and block != current:
                yield asked(current, held)
                held = []
            current = block
            held.append(batch)
        if held:
            yield asked(current, held)

    return docs.mapInArrow(ask, _REQUEST)


def _answers(requests):
    """Totals that a block cannot know itself; block -1 has the sums of a bucket."""

    names = ["block", "tokens", "n", "keys", "counts"]

    def answer(table):
        blocks = table.column("block").to_pylist()
        if table.column("bucket")[0].as_py() < 0:
            nothing = pa.nulls(len(blocks), pa.binary())
            columns = [table.column("block"), table.column("n"), pa.array([0] * len(blocks))]
            return pa.Table.from_arrays([*columns, nothing, nothing], names)
        asked = [
            _unpack(*row)
            for row in zip(*(table.column(c).to_pylist() for c in ("n", "keys", "counts")))
        ]
        keys, totals = _summed([k for k, _ in asked], [c for _, c in asked])
        word = (keys & np.uint64(1)) == 0
        word &= keys != _unigrams(_START)
        rows = [(-1, 0, int((word & (totals > 0)).sum()), b"", b"")]
        rows[0] = (-1, int(totals[word].sum()), *rows[0][2:])
        for block, (own, counts) in zip(blocks, asked):
            total = totals[np.searchsorted(keys, own)]
            other = total != counts
            if other.any():
                n, packed, sums = _pack(own[other], total[other])
                rows.append((block, 0, n, packed, sums))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names
        )

    return requests.groupBy("bucket").applyInArrow(
        answer, "block bigint, tokens bigint, n bigint, keys binary, counts binary"
    )


def _checksum(batches):
    """A checksum of the ids and texts of a block, whatever their order."""
    total = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))
        for doc, fold, text in zip(*columns):
            head = zlib.crc32(f"{doc} {fold} {text is None} ".encode())
            total += zlib.crc32((text or "").encode("utf-8", "replace"), head)
    return total


class Automaton:
    """Arcs of the n-grams that a block of texts can meet."""

    def __init__(self, keys, counts, tokens, types, strength):
        seen = counts > 0
        self.keys, self.counts = keys[seen], counts[seen]
        self.tokens, self.types, self.strength = tokens, types, strength

    def _count(self, keys):
        if len(self.keys) == 0:
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    def read(self, tokens, bounds):
        """Per text: tokens, known tokens, base score, score of the path."""
        often = self._count(_unigrams(tokens))
        p = (often + 1) / (self.tokens + self.types + 1)
        # The state before each token: the last word's, or the start's.
        state = np.empty_like(often)
        state[1:] = often[:-1]
        starts = self._count(_unigrams(np.full(len(bounds) - 1, _START)))
        state[bounds[:-1]] = starts
        arc = self._count(_bigrams(_histories(tokens, bounds), tokens))
        weight = np.log10((arc + self.strength * p) / (state + self.strength))
        first = bounds[:-1]
        sums = (np.add.reduceat(x, first) for x in (often > 0, np.log10(p), weight))
        known, base, path = sums
        return np.diff(bounds), known.astype(np.int64), base, path


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint,"
    " train_tokens bigint, base_score double, score double"
)


def score(docs, held_out, strength=4.0):
    """Scores of every text, learnt from the rows where ``held_out`` is not true.

    ``docs`` has ``doc_id`` and ``text``; ``held_out`` is a column expression.
    ``docs`` must give the same rows in the same tasks when read again, as a table
    that is stored does; this is verified, and an error says so if it does not.
    """
    docs = tables.documents(docs).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // 5 // BUCKET))
    requests = _requests(docs, buckets)
    answers = tables.written(_answers(requests), "lm-answers")
    tokens, types = answers.where("block = -1").agg(F.sum("tokens"), F.sum("n")).first()
    tokens, types = tokens or 0, types or 0

    def labelled(batches):
        for block, batch in _blocks(batches):
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), *batch.columns,
                 *(pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                ["block", "doc_id", "text", "held_out", "tokens", "n", "keys", "counts"],
            )

    joined = (
        "block bigint, doc_id bigint, text string, held_out boolean,"
        " tokens bigint, n bigint, keys binary, counts binary"
    )
    rows = docs.mapInArrow(labelled, joined).unionByName(
        answers.where("block >= 0").select("block", "tokens", "n", "keys", "counts"),
        allowMissingColumns=True,
    )

    def read(table):
        asked = table.filter(pa.compute.is_valid(table.column("n")))
        sums = asked.filter(pa.compute.is_null(asked.column("keys")))
        asked = asked.filter(pa.compute.is_valid(asked.column("keys")))
        docs = table.filter(pa.compute.is_null(table.column("n"))).combine_chunks()
        if sums.column("tokens").to_pylist() != [_checksum(docs.to_batches())]:
            raise ValueError("the documents were dealt otherwise when read again; store them first")
        # A block's own counts hold wherever no answer came.
        keys, counts = _counted(docs.to_batches())
        for row in zip(*(asked.column(c).to_pylist() for c in ("n", "keys", "counts"))):
            other, totals = _unpack(*row)
            counts[np.searchsorted(keys, other)] = totals
        model = Automaton(keys, counts, tokens, types, strength)
        data, offsets = words.utf8(docs.column("text"))
        made = []
        for i, j in words.slices(offsets):
            text, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            made.append(model.read(*_tokens(text, at)))
        n, known, base, path = (np.concatenate(x) for x in zip(*made))
        return pa.Table.from_arrays(
            [docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks(),
             pa.array(n), pa.array(known), pa.array(np.full(len(n), tokens)),
             pa.array(base), pa.array(path)],
            [f.split()[0] for f in _SCORES.split(", ")],
        )

    return rows.groupBy("block").applyInArrow(read, _SCORES)
