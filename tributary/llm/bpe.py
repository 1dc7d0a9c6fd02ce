"""Byte-level BPE by batched merge rounds.

Many texts are one flat array of code points.  Array operations find where the
pre-tokens begin; each pre-token is hashed to 64 bits, and only the distinct ones
that the task has not met before (it remembers up to ``KEPT``) are encoded.

Their bytes are laid end to end as one flat array of symbols.  In each round each
pre-token takes its pair of neighbours of lowest rank, and all its occurrences are
merged at once, from the left; ranks are found by binary search in the sorted keys
of all merges, and only pairs with a symbol just made are looked up again.
Pre-tokens without a pair left drop out, so the array shrinks from round to round.

Cases: a null text encodes as an empty one, to no ids.  The strings of added
tokens become their ids.  Ids of null are null, and decoded text of null is null;
ids outside the vocabulary decode to nothing, bytes that are no UTF-8 to U+FFFD.
Other columns of the input are kept; a column of a result's name is replaced.
"""

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm import words

#: Pre-tokens whose ids a task remembers; more than that, and it starts afresh.
KEPT = 1_000_000
#: Code points that one round of array operations handles.
SLICE = 1 << 21

_OTHER, _LETTER, _NUMBER, _BLANK = range(4)
# White space, and the endings that are pre-tokens of their own.
_BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ENDINGS = "s t re ve m ll d".split()


@lru_cache(maxsize=1)
def _classes():
    """The class of every code point."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    table = np.array(
        [kinds.get(unicodedata.category(chr(i))[0], _OTHER) for i in range(0x110000)], np.uint8
    )
    blank = re.compile(f"[{_BLANKS}]")
    table[[i for i in range(0x3001) if blank.match(chr(i))]] = _BLANK
    return table


@lru_cache(maxsize=1)
def _numbers():
    """A 64-bit number for every code point."""
    return words.mix(np.arange(1, 0x110001, dtype=np.uint64))


def pre_tokens(points, bounds):
    """Where the pre-tokens of texts (code points, and where texts begin) begin."""
    n = len(points)
    kinds = _classes()[points]
    begins = np.empty(n, bool)
    begins[:1] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    first = first[:n]
    begins |= first
    # A blank before a word belongs to it; of several white spaces the last
    # one stands alone or, if a blank, goes with the word.
    after = np.flatnonzero(begins & (kinds != _BLANK) & ~first)
    after = after[kinds[after - 1] == _BLANK]
    begins[after - 1] = True
    begins[after[points[after - 1] == 0x20]] = False
    # Endings such as 's, where a pre-token begins with the apostrophe.
    marks = np.flatnonzero(begins & (points == 0x27))
    for ending in _ENDINGS:
        k = len(ending)
        at = marks[marks + k < n]
        for d, letter in enumerate(ending, 1):
            at = at[(points[at + d] == ord(letter)) & ~first[at + d]]
        begins[at + 1] = False
        rest = at[at + k + 1 < n] + k + 1
        begins[rest[kinds[rest] == _LETTER]] = True
        # An ending found is not looked at again.
        marks = np.setdiff1d(marks, at, assume_unique=True)
    return np.flatnonzero(begins)


def _letters():
    """The printable letter that stands for each byte in a vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain}
    return letters | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """A vocabulary file of the tokenizers library, ready to encode and decode."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        vocab, letters = held["model"]["vocab"], _letters()
        byte_of = {letter: b for b, letter in letters.items()}
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        added = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.bytes = [b""] * self.size
        for token, i in vocab.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            self.bytes[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in held["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.into = keys[order], order, into[order]
        self.added = {t: np.array([i], "<u4").tobytes() for t, i in added.items()}
        self.at_added = (
            re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))))
            if added
            else None
        )
        self.spelt = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.spelt_size = np.fromiter(map(len, self.bytes), np.int64, self.size)
        self.spelt_at = np.cumsum(self.spelt_size) - self.spelt_size
        self._forget()

    def _forget(self):
        self.known = np.zeros(0, np.uint64)
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _pairs(self, left, right):
        """Rank and merged symbol of each pair; the largest number for no merge."""
        keys = left * self.size + right
        found = np.searchsorted(self.keys, keys)
        found[found == len(self.keys)] = 0
        hit = self.keys[found] == keys
        return np.where(hit, self.ranks[found], np.iinfo(np.int32).max), self.into[found]

    def merged(self, tokens):
        """Ids of each of ``tokens`` (bytes, none empty), and how many."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbols = self.first[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        none, done = np.iinfo(np.int32).max, []
        rank, into = self._pairs(symbols[:-1], symbols[1:])
        rank[owner[:-1] != owner[1:]] = none
        rank, into = np.append(rank, none).astype(np.int32), np.append(into, 0)
        while len(symbols):
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(owner)))
            live = np.repeat(best != none, sizes)
            done.append((owner[~live], symbols[~live]))
            at = np.flatnonzero(live & (rank == np.repeat(best, sizes)))
            if not len(at):
                break
            # Of a run of overlapping pairs (a a a) every other one is merged.
            if (np.diff(at) == 1).any():
                head = np.append(True, np.diff(at) != 1)
                since = np.arange(len(at)) - np.maximum.accumulate(
                    np.where(head, np.arange(len(at)), 0)
                )
                at = at[since % 2 == 0]
            symbols[at] = into[at]
            live[at + 1] = False
            moved = np.zeros(len(symbols), bool)
            moved[at] = True
            symbols, owner, rank, into, moved = (
                x[live] for x in (symbols, owner, rank, into, moved)
            )
            # Only pairs with a symbol just made are looked up again.
            changed = moved.copy()
            changed[:-1] |= moved[1:]
            changed = np.flatnonzero(changed)
            if len(changed) and changed[-1] == len(symbols) - 1:
                rank[-1] = none
                changed = changed[:-1]
            new_rank, into[changed] = self._pairs(symbols[changed], symbols[changed + 1])
            new_rank[owner[changed] != owner[changed + 1]] = none
            rank[changed] = new_rank
        owner = np.concatenate([o for o, _ in done])
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate([s for _, s in done])[order]
        return flat, np.bincount(owner, minlength=len(tokens))

    def _learn(self, keys, tokens):
        """Remember the ids of pre-tokens (sorted hashes, UTF-8)."""
        flat, counts = self.merged(tokens)
        if self.used + len(flat) > len(self.pool):
            grown = np.zeros(2 * (self.used + len(flat)), np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + len(flat)] = flat
        place = np.searchsorted(self.known, keys)
        starts = self.used + np.cumsum(counts) - counts
        self.known = np.insert(self.known, place, keys)
        self.at = np.insert(self.at, place, starts)
        self.count = np.insert(self.count, place, counts)
        self.used += len(flat)

    def _ids(self, segments):
        """Ids of texts without added tokens, and where those of each text begin."""
        flat = "".join(segments)
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, segments), np.int64))])
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        points = np.frombuffer(flat.encode("utf-32-le", "replace"), "<u4")
        starts = pre_tokens(points, bounds)
        hashes = words.mix(words.polynomial(_numbers()[points], starts))
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > KEPT:
            self._forget()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            ends = np.append(starts[1:], len(points))
            spots = first[new]
            pairs = zip(starts[spots].tolist(), ends[spots].tolist())
            self._learn(distinct[new], [flat[a:b].encode("utf-8", "replace") for a, b in pairs])
            place = np.searchsorted(self.known, distinct)
        counts = self.count[place][inverse]
        ends = np.cumsum(counts)
        at = np.repeat(self.at[place][inverse] - ends + counts, counts) + np.arange(ends[-1])
        token_bounds = np.searchsorted(starts, bounds)
        return self.pool[at], np.concatenate([[0], ends])[token_bounds]

    def encode(self, texts):
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        parts = [self._segments(text or "") for text in texts]
        plain = [p for segments in parts for p in segments[::2]]
        raws = []
        for i, j in batches(plain, SLICE):
            ids, bounds = self._ids(plain[i:j])
            raw, ends = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
            raws += [raw[a:b] for a, b in zip(ends, ends[1:])]
        made, at = [], 0
        for segments in parts:
            n = len(segments) // 2 + 1
            if n == 1:
                made.append(raws[at])
            else:
                added = [*(self.added.get(t, b"") for t in segments[1::2]), b""]
                made.append(b"".join(x for p in zip(raws[at : at + n], added) for x in p))
            at += n
        return made

    def _segments(self, text):
        """Text and added tokens in turn, text first and last; "" is a mere cut."""
        if not any(token in text for token in self.added):
            made = [text]
        else:
            found = self.at_added.findall(text)
            plain = self.at_added.split(text)
            made = [x for pair in zip(plain, found) for x in pair] + [plain[-1]]
        if len(text) <= CUT:
            return made
        parts = [[x] if k % 2 else _joined(_cut(x)) for k, x in enumerate(made)]
        return [x for part in parts for x in part]

    def decode(self, ids):
        """The text of a sequence of ids."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < self.size)]
        counts = self.spelt_size[ids]
        ends = np.cumsum(counts)
        if not len(ends):
            return ""
        at = np.repeat(self.spelt_at[ids] - ends + counts, counts) + np.arange(ends[-1])
        return self.spelt[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path):
    """The codec of a file, once per process."""
    return Codec(path)


def compact(path):
    """The smallest of 16 and 32 bits that holds every id of a vocabulary."""
    return "<u2" if codec(path).size <= 1 << 16 else "<u4"


#: Characters from which a text is cut, at a blank behind a plain sign: no pre-token
#: reaches over such a place.
CUT = 1 << 20
_PLACE = re.compile(r"(?<=[A-Za-z0-9,.])(?=[ \n])")


def _cut(text):
    """``text`` in parts of little more than CUT characters, if it has such places."""
    parts, first = [], 0
    while len(text) - first > CUT:
        place = _PLACE.search(text, first + CUT)
        if place is None:
            break
        parts.append(text[first : place.start()])
        first = place.start()
    return [*parts, text[first:]]


def _joined(parts):
    return [x for part in parts for x in (part, "")][:-1]


def batches(texts, most=1 << 20):
    """Ranges of a sequence of texts with about ``most`` characters each."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= most:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def encode(df, path, text="text", ids="ids"):
    """``df`` with ``ids``, the token ids (array of INT) of the whole ``text``."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encoded(column: pd.Series) -> pd.Series:
        texts, made = column.tolist(), []
        for i, j in batches(texts):
            made += [np.frombuffer(x, "<i4") for x in codec(path).encode(texts[i:j])]
        return pd.Series(made, index=column.index, dtype=object)

    return df.withColumn(ids, encoded(F.col(f"`{text}`").cast("string")))


def decode(df, path, ids="ids", text="decoded"):
    """``df`` with ``text``, what the token ids in ``ids`` stand for."""

    @F.pandas_udf(T.StringType())
    def decoded(column: pd.Series) -> pd.Series:
        known = codec(path)
        made = [None if x is None else known.decode(x) for x in column]
        return pd.Series(made, index=column.index, dtype=object)

    return df.withColumn(text, decoded(F.col(f"`{ids}`")))


def digests(df, path, text="text"):
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256 of the whole text (null
    is empty), encoded and decoded in small batches; ids are hashed as text, by commas."""
    rows = df.select("doc_id", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))

    def work(found):
        known = codec(path)
        for batch in found:
            _, offsets = words.utf8(batch.column("text"))
            for i, j in words.slices(offsets, 1 << 20):
                made = []
                for raw in known.encode(batch.column("text").slice(i, j - i).to_pylist()):
                    ids = np.frombuffer(raw, "<u4")
                    listed = ",".join(map(str, ids.tolist())).encode()
                    decoded = known.decode(ids).encode("utf-8", "replace")
                    made.append((len(ids), *(hashlib.sha256(x).hexdigest() for x in (listed, decoded))))
                kinds = [pa.int64(), pa.string(), pa.string()]
                columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *columns],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return rows.mapInArrow(work, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
