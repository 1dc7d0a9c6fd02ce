"""Phrases that occur often and hold together, per language.

Rabin-Karp fingerprints: the words of many texts, one blank between them, are one
flat array of bytes; prefix polynomials modulo primes with bases drawn at random give
the fingerprint of every run of words by a subtraction (two primes), and a residue
that is independent of it (a third one).  Tasks add up the fingerprints of about
``HELD`` runs before these are shuffled, so a very common run moves once per so many.
With its number a fingerprint carries a pointer to a text that holds it (the least hash
of all those texts) and the sum of the residues of its occurrences.  Only frequent runs
are made texts, where their pointers lead, and a run's residue must then be the mean of
all.  Where it is not, runs collided: they are looked up in all texts and counted by
their bytes.

A run is as frequent as its parts at most.  Words are counted first, then pairs of
frequent words, then longer runs of frequent pairs.  Frequent fingerprints go back to
the texts by a broadcast while they are measured to be ``BOUND`` at most; beyond it,
runs are not sifted, and pointers meet the texts in a join.  Both ways give the same
rows.

Cases: a null or empty text has no words; a null language is ``und``.  Repeated rows
count each.  Empty tables give no rows.  A text without any mark is one piece, however
long.  Ids and other columns are not looked at.
"""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary.llm import tables, words
from tributary.operators import scale

#: Marks between pieces, and blanks between words.
MARKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

LONGEST, OFTEN, BEST = 5, 100, 2000

#: Fingerprints that are broadcast at most (8 bytes each), and runs that a task adds up.
BOUND, HELD = 4_000_000, 1_000_000

#: Rows of an Arrow batch that goes back to Spark.
ROWS = 50_000

_MARK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(MARKS)] = True
_BLANK[list(MARKS + BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Polynomial:
    """Prefix polynomials modulo a prime below 2**31."""

    def __init__(self, prime, base):
        self.prime, self.base = prime, base
        self.inverse = pow(base, -1, prime)
        self.up = self.down = np.ones(1, np.uint32)

    def _powers(self, base, n):
        made = np.ones(1, np.uint64)
        while len(made) < n:
            made = np.concatenate([made, made * np.uint64(pow(base, len(made), self.prime)) % np.uint64(self.prime)])
        return made[:n].astype(np.uint32)

    def prefixes(self, data, *places):
        """Values of the first bytes of ``data``, for each array of numbers of bytes."""
        n, prime = len(data), np.uint64(self.prime)
        if len(self.up) < n:
            self.up, self.down = self._powers(self.base, n), self._powers(self.inverse, n)
        # Sums of 2**16 products stay below 2**55.
        wide = -(-n // 65536) * 65536
        terms = np.zeros(wide + 1, np.uint64)
        np.add(data, np.uint64(1), out=terms[1 : n + 1])
        terms[1 : n + 1] *= self.up[:n]
        sums = terms[1:].reshape(-1, 65536)
        np.cumsum(sums, axis=1, out=sums)
        before = np.cumsum(np.concatenate([[0], sums[:, -1] % prime]).astype(np.uint64)) % prime
        # Remainders are taken where they are asked for; no byte stands before the first.
        return [(terms[at] + before[np.maximum(at - 1, 0) >> 16]) % prime for at in places]

    def between(self, first, last, down):
        """Values of runs, by the prefixes before and with them; ``down`` is of their starts."""
        # The product stays below 2**63.
        return (last + np.uint64(self.prime) - first) * down % np.uint64(self.prime)

    def runs(self, data, starts, ends):
        """Values of the runs of bytes from ``starts`` to ``ends``."""
        return self.between(*self.prefixes(data, starts, ends), self.down[starts])


_RANDOM = np.random.default_rng(20240612)
_POLYNOMIALS = [
    _Polynomial(p, int(_RANDOM.integers(2**20, 2**30))) for p in (2**31 - 1, 2**31 - 19, 2**31 - 61)
]

#: Bits of a residue that are added up: sums of 2**42 of them fit in 64 bits.
_RESIDUE = (1 << 21) - 1


def _text_hashes(data, offsets):
    return [zlib.crc32(data[i:j]) for i, j in zip(offsets[:-1], offsets[1:])]


def _flat(batch):
    """Slices of the batch's texts at marks: bytes, where texts end, their languages and
    their hashes."""
    data, offsets = words.utf8(batch.column("text"))
    langs = batch.column("lang").to_pylist()
    # Few texts at a time, as all that is made of their bytes is several times as large.
    for i, j in words.slices(offsets):
        yield from _marked(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], langs[i:j])


def _marked(data, offsets, langs):
    n = len(langs)
    hashes = np.array(_text_hashes(data, offsets), np.int64)
    # A mark behind each text keeps its words from the next one's.
    at = offsets[1:]
    flat, ends = np.insert(_LOWER[data], at, MARKS[0]), at + np.arange(1, n + 1)
    marks = np.flatnonzero(_MARK[flat])
    names = sorted(set(langs))
    codes = np.array([names.index(x) for x in langs])
    first = 0
    while first < len(flat):
        k = np.searchsorted(marks, first + words.SLICE // 4)
        last = int(marks[min(k, len(marks) - 1)]) + 1
        yield flat[first:last], ends - first, codes, names, hashes
        first = last


class Runs:
    """Words of a slice in one array, one blank behind each, and their runs."""

    def __init__(self, data, ends, codes, names, hashes):
        inside = ~_BLANK[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        starts = np.flatnonzero(begins)
        # A blank or mark follows each word, as a mark ends the slice.
        stops = inside.copy()
        stops[1:] |= inside[:-1]
        kept = np.where(inside, data, 32)[stops]
        self.bytes = kept
        here = inside[stops]
        self.starts = np.flatnonzero(here & np.concatenate([[True], ~here[:-1]]))
        self.ends = np.flatnonzero(~here)
        piece = np.cumsum(_MARK[data])[starts]
        text = np.searchsorted(ends, starts, "right")
        self.codes, self.names = codes[text], names
        self.pointers = hashes[text]
        # How many words follow within the piece.
        last = np.searchsorted(piece, piece, "right") - 1
        self.room = last - np.arange(len(starts))
        self.prefixes = {}

    def values(self, k, at, n):
        """Polynomial ``k`` of the runs of ``n`` words at ``at``; prefixes are made once a slice."""
        polynomial = _POLYNOMIALS[k]
        if k not in self.prefixes:
            made = polynomial.prefixes(self.bytes, self.starts, self.ends)
            self.prefixes[k] = *made, polynomial.down[self.starts]
        first, last, down = self.prefixes[k]
        return polynomial.between(first[at], last[at + n - 1], down[at])

    def hashes(self, at, n):
        """Fingerprints of the runs of ``n`` words at ``at``, language included."""
        a, b = (self.values(k, at, n) for k in range(2))
        salt = np.array([hash_of(name) for name in self.names], np.uint64)
        return words.mix((a << np.uint64(31) | b) ^ salt[self.codes[at]])

    def residues(self, at, n):
        return (self.values(2, at, n) & np.uint64(_RESIDUE)).astype(np.uint32)

    def places(self, n):
        return np.flatnonzero(self.room >= n - 1)

    def text(self, i, n):
        return self.bytes[self.starts[i] : self.ends[i + n - 1]].tobytes()


def hash_of(name):
    """A number for a language."""
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def _among(values, sorted_keys):
    if len(sorted_keys) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    return sorted_keys[at] == values


def _candidates(runs, lengths, known):
    """(n, places, fingerprints) of the runs that may be frequent.

    ``known`` has the sorted fingerprints of frequent words and pairs, or None for a
    level that does not sift.
    """
    fine = np.ones(len(runs.starts), bool)
    if known.get(1) is not None:
        at = runs.places(1)
        fine[at] = _among(runs.hashes(at, 1), known[1])
    pair = np.zeros(len(fine), bool)
    at = runs.places(2)
    at = at[fine[at] & fine[at + 1]]
    held = None
    if known.get(2) is not None or 2 in lengths:
        held = runs.hashes(at, 2)
    pair[at] = True if known.get(2) is None else _among(held, known[2])
    for n in lengths:
        if n == 1:
            places = runs.places(1)
            yield 1, places, runs.hashes(places, 1)
        elif n == 2:
            yield 2, at, held
        else:
            places = runs.places(n)
            for k in range(n - 1):
                places = places[pair[places + k]]
            yield n, places, runs.hashes(places, n)


_COUNTS = "fp bigint, lang string, f bigint, residues bigint, pointer bigint"


def _added(waiting, total):
    """Number, sum of residues and pointer of each fingerprint; words of each language."""
    # What was found last may have been sent already; the numbers of words are sent still.
    waiting = waiting or [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int64))]
    keys, residues, pointers = (np.concatenate(column) for column in zip(*waiting))
    order = np.argsort(keys)
    keys, residues, pointers = keys[order], residues[order].astype(np.int64), pointers[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    numbers = np.diff(np.append(heads, len(keys)))
    columns = [keys[heads].view(np.int64), numbers]
    if len(heads):
        columns += [np.add.reduceat(residues, heads), np.minimum.reduceat(pointers, heads)]
    else:
        columns += [heads, heads]
    extra = len(total)
    made = [pa.concat_arrays([pa.array(c, pa.int64()), pa.nulls(extra, pa.int64())]) for c in columns]
    made[1] = pa.array([*numbers.tolist(), *total.values()], pa.int64())
    made.insert(1, pa.array([None] * len(heads) + list(total), pa.string()))
    return pa.RecordBatch.from_arrays(made, ["fp", "lang", "f", "residues", "pointer"])


def _sliced(batch):
    return (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS))


def _frequent(docs, lengths, known, often):
    """Runs of ``lengths`` words found ``often`` or more, and words per language (fp null)."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        waiting, total, size = [], {}, 0
        for batch in batches:
            for part in _flat(batch):
                runs = Runs(*part)
                if 1 in lengths:
                    for code, f in enumerate(np.bincount(runs.codes, minlength=len(runs.names))):
                        name = runs.names[code]
                        total[name] = total.get(name, 0) + int(f)
                for n, places, keys in _candidates(runs, lengths, held.value):
                    waiting.append((keys, runs.residues(places, n), runs.pointers[places]))
                    size += len(keys)
                if size >= HELD:
                    yield from _sliced(_added(waiting, {}))
                    waiting, size = [], 0
        if waiting or total:
            yield from _sliced(_added(waiting, total))

    rows = docs.mapInArrow(count, _COUNTS).groupBy("fp", "lang")
    rows = rows.agg(
        F.sum("f").alias("f"), F.sum("residues").alias("residues"), F.min("pointer").alias("pointer")
    )
    wanted = (F.col("f") >= often) | (F.col("fp").isNull() & (F.col("f") > 0))
    return tables.written(rows.where(wanted), "phrases-frequent")


def _keys(frame):
    return np.sort(frame.select("fp").toArrow().column("fp").to_numpy().astype(np.int64).view(np.uint64))


def _collected(frequent, bound):
    """The fingerprints as a sorted array if they are ``bound`` at most, else None."""
    frequent = frequent.where("fp is not null")
    return None if frequent.count() > bound else _keys(frequent)


_RESOLVED = "fp bigint, pointer bigint, lang string, n int, phrase string, residue bigint"


def _runs_of(batch, wanted):
    """The runs of texts whose (fingerprint, pointer) ``wanted`` holds, each once a slice."""
    for part in _flat(batch):
        runs = Runs(*part)
        for n, places, keys in _candidates(runs, range(1, LONGEST + 1), {}):
            found = wanted(keys, runs.pointers[places])
            _, first = np.unique(keys[found], return_index=True)
            places, keys = places[found][first], keys[found][first]
            texts = [runs.text(i, n) for i in places.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(runs.pointers[places]),
                 pa.array([runs.names[c] for c in runs.codes[places].tolist()], pa.string()),
                 pa.array(np.full(len(keys), n, np.int32)), pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array(runs.residues(places, n).astype(np.int64))],
                [f.split()[0] for f in _RESOLVED.split(", ")],
            )


def _resolved(docs, frequent, bound):
    """(fp, pointer, lang, n, phrase, residue): runs in the texts that pointers lead to."""
    if frequent.count() <= bound:
        table = frequent.select("fp", "pointer").toArrow()
        keys = table.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        known = keys[order], table.column("pointer").to_numpy()[order]
        held = docs.sparkSession.sparkContext.broadcast(known)

        def wanted(keys, pointers):
            sorted_, places = held.value
            at = np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)
            return (sorted_[at] == keys) & (places[at] == pointers)

        def look(batches):
            hashes = np.unique(held.value[1])
            for batch in batches:
                own = np.array(_text_hashes(*words.utf8(batch.column("text"))), np.int64)
                some = np.flatnonzero(np.isin(own, hashes))
                if len(some):
                    yield from _runs_of(batch.take(pa.array(some)), wanted)

        return docs.mapInArrow(look, _RESOLVED)

    def every(batches):
        for batch in batches:
            # One text at a time, as each has its own pointer.
            for i in range(batch.num_rows):
                yield from _runs_of(batch.slice(i, 1), lambda keys, _: np.ones(len(keys), bool))

    # Only texts that pointers lead to are read again; none of them moves.
    places = frequent.select(F.col("pointer").alias("h")).distinct()
    named = docs.withColumn("h", F.crc32(F.coalesce("text", F.lit(""))))
    runs = named.join(scale.broadcast_if_small(places), "h", "left_semi").drop("h").mapInArrow(every, _RESOLVED)
    return runs.join(frequent.select("fp", "pointer"), ["fp", "pointer"], "left_semi")


_TEXTS = "lang string, n int, phrase string, f bigint, fp bigint"


def _texts(docs, known, sift):
    """(lang, n, phrase, f, fp): runs as texts, each task's added up."""
    held = docs.sparkSession.sparkContext.broadcast((known, sift))

    def find(batches):
        (known, sift), tally = held.value, {}

        def added():
            rows = [(lang, n, text, f, fp) for (lang, n, fp, text), f in tally.items()]
            tally.clear()
            kinds = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            columns[2] = columns[2].cast(pa.string())
            return pa.RecordBatch.from_arrays(columns, ["lang", "n", "phrase", "f", "fp"])

        for batch in batches:
            for part in _flat(batch):
                runs = Runs(*part)
                for n, places, keys in _candidates(runs, range(1, LONGEST + 1), known):
                    if sift is not None:
                        found = _among(keys, sift)
                        places, keys = places[found], keys[found]
                    if len(places) == 0:
                        continue
                    _compare(runs, n, places, keys, tally)
                if len(tally) >= HELD // 10:
                    yield added()
        if tally:
            yield added()

    return docs.mapInArrow(find, _TEXTS)


def _compare(runs, n, places, keys, tally):
    """Add runs to ``tally`` by text; those of one fingerprint are compared byte by byte."""
    if len(keys) == 0:
        return
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(keys))))
    starts, sizes = runs.starts[places], runs.ends[places + n - 1] - runs.starts[places]
    model, long = starts[heads][group], sizes[heads][group]
    same = (sizes == long) & (runs.codes[places] == runs.codes[places[heads]][group])
    # All bytes of all runs beside those of the first run with their fingerprint.
    shown = np.flatnonzero(same)
    for i in range(0, len(shown), 200_000):
        some = shown[i : i + 200_000]
        ends = np.cumsum(sizes[some])
        step = np.arange(ends[-1]) - np.repeat(ends - sizes[some], sizes[some])
        apart = runs.bytes[np.repeat(starts[some], sizes[some]) + step]
        apart = apart != runs.bytes[np.repeat(model[some], sizes[some]) + step]
        same[some] = np.add.reduceat(apart, ends - sizes[some]) == 0
    numbers = np.bincount(group[same], minlength=len(heads))
    odd = np.flatnonzero(~same)
    for at, number in [*zip(heads.tolist(), numbers.tolist()), *((int(i), 1) for i in odd)]:
        i = int(places[at])
        key = (runs.names[runs.codes[i]], n, int(keys[at : at + 1].view(np.int64)[0]), runs.text(i, n))
        tally[key] = tally.get(key, 0) + number


def frequent(docs, often=OFTEN, bound=BOUND):
    """(lang, n, phrase, f): phrases of up to LONGEST words with f of ``often`` or more,
    and with n = 0 the number of words of each language."""
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    known, found = {}, []
    for level in ([1], [2], range(3, LONGEST + 1)):
        found.append(_frequent(docs, level, known, often))
        if len(found) < 3:
            known[level[0]] = _collected(found[-1], bound)
    every = found[0].unionByName(found[1]).unionByName(found[2])
    total = every.where("fp is null").select("lang", F.lit(0).alias("n"), F.lit("").alias("phrase"), "f")
    runs = every.where("fp is not null").drop("lang")
    # Equal texts, and slices of one, give a run more than once.
    texts = _resolved(docs, runs, bound).drop("pointer").distinct()
    named = runs.withColumnRenamed("fp", "key").join(texts, F.col("fp") == F.col("key"))
    # Several runs of one fingerprint in the text are told by the mean, too.
    named = named.withColumn("alone", F.col("residue") * F.col("f") == F.col("residues"))
    named = tables.written(named, "phrases-named")
    counted = total.unionByName(named.where("alone").select("lang", "n", "phrase", "f"))
    collided = tables.written(named.where("not alone").select("fp").distinct(), "phrases-collided")
    if not collided.isEmpty():
        counted = counted.unionByName(_recounted(docs, known, collided, often, bound))
    return tables.written(counted, "phrases")


def _recounted(docs, known, collided, often, bound):
    """(lang, n, phrase, f) of runs whose fingerprints collided, counted by text."""
    if collided.count() <= bound:
        texts = _texts(docs, known, _keys(collided))
    else:
        texts = _texts(docs, known, None).join(collided, "fp", "left_semi")
    counted = texts.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= often)


def _words(first, last):
    """Words ``first`` to ``last`` (from 1) of the phrase."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def scored(counted):
    """(lang, phrase, n_words, a, l, r, n, score) of the candidates in ``counted``."""
    often = counted.where("n > 0").select("lang", "phrase", F.col("f"))
    total = counted.where("n = 0").select("lang", F.col("f").alias("n"))
    cuts = counted.where("n > 1").select(
        "lang", "phrase", F.col("n").alias("m"), F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"),
    )
    cuts = cuts.withColumns({"first": _words(F.lit(1), F.col("k")), "rest": _words(F.col("k") + 1, F.col("m"))})
    first = often.withColumnsRenamed({"phrase": "first", "f": "l"})
    rest = often.withColumnsRenamed({"phrase": "rest", "f": "r"})
    joined = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"])
    # One row a language, to be joined with as many rows as there are cuts.
    joined = joined.join(scale.broadcast_if_small(total), "lang")
    score = F.expr(
        "(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)))"
        " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    )
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return joined.groupBy("lang", "phrase", "m", "a", "n").agg(least).select(
        "lang", "phrase", F.col("m").alias("n_words"), "a", "cut.l", "cut.r", "n", "cut.score"
    )


def collocations(docs, often=OFTEN, best=BEST, bound=BOUND):
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counted = frequent(docs, often, bound)
    made = scored(counted)
    # What holds a phrase holds it with one more word before or behind, too.
    m = F.col("n")
    inner = counted.where("n > 2").select(
        "lang", "f", F.explode(F.array(_words(F.lit(1), m - 1), _words(F.lit(2), m))).alias("phrase")
    )
    inside = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = made.join(inside, ["lang", "phrase"], "left")
    left = left.where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
