"""Toxicity of disguised text, by a noisy channel and a lexicon learnt from labels.

Restoring: what was meant was written letter by letter, but a letter may have been
replaced by a sign that looks like it, repeated, or followed by a blank or mark.
Each suspicious token (letters beside digits or signs, a sign three times in a row,
letters that stand alone in a row) is a lattice of readings; Viterbi's algorithm finds
the likeliest one under a language model of characters, trigrams of byte classes
counted over the words of all texts.  Other tokens have one reading.

Scoring: of half of a bounded sample of labelled texts (``SAMPLE``), words and word
beginnings of restored texts are counted by label; those seen with label 1 too often for
chance are the lexicon, weighted by their log odds.  A text is described by its
strongest word, how many words it has from the lexicon, the sum of their weights and
their share; a logistic function of these, fitted on the other half, is the score.

Whole texts are restored and scanned.  The model is broadcast: a table of ``CLASSES``
cubed numbers and ``LEXICON`` entries at most.

Cases: a null or empty text has no words and gets a score.  Labels that are null are
not learnt from, of several labels of an id the largest counts; with one label alone
every score is the share of label 1, without labels 0.5.  Repeated rows are scored
each.  An empty table gives no rows.  Other columns are not looked at.
"""

import math
import re
from collections import Counter
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.llm import tables, words

#: Labelled texts learnt from, and entries of the lexicon, at most.
SAMPLE, LEXICON = 8_000, 20_000

#: Orders of shingles by which copies in the sample are found.
COPY_KEYS = 4

#: Signs and the letters they may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "{": "c", "<": "c", "€": "e", "£": "l",
}
#: Signs that may be written between letters without a meaning.
BETWEEN = " .-_*~'^/\\"

#: Costs (natural logarithms) of a replaced, a repeated and a filling sign.
REPLACED, REPEATED, FILLED = 1.2, 0.3, 0.5

#: Lengths of word beginnings in the lexicon.
BEGINNINGS = (4, 5, 6)

#: Classes of bytes: between words, letters, digits, others of ASCII, all high bytes.
CLASSES = 1 + 26 + 10 + 1 + 128
_CLASS = np.full(256, 37, np.int64)
_CLASS[128:] = np.arange(38, 166)
_CLASS[97:123] = _CLASS[65:91] = np.arange(1, 27)
_CLASS[48:58] = np.arange(27, 37)
_CLASS[list(b" \t\n\x0b\x0c\r.,;:!?\"()[]")] = 0
_LIST = _CLASS.tolist()


def character_counts(docs):
    """(key, n): how often each trigram of classes is in words of all texts."""

    def count(batches):
        sums = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            # A text's end lies between words; slices are cut there, or at a blank.
            classes = np.insert(_CLASS[data], offsets[1:], 0)
            edges, first = np.flatnonzero(classes == 0), 0
            while first < len(classes):
                k = np.searchsorted(edges, first + words.SLICE)
                last = int(edges[min(k, len(edges) - 1)]) + 1
                part = np.insert(classes[first:last], 0, 0)
                part = part[np.append(True, (part[1:] != 0) | (part[:-1] != 0))]
                part, first = np.repeat(part, np.where(part == 0, 2, 1)), last
                keys = (part[:-2] * CLASSES + part[1:-1]) * CLASSES + part[2:]
                sums += np.bincount(keys, minlength=len(sums))
        keys = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums[keys])], ["key", "n"])

    rows = docs.select("text").mapInArrow(count, "key bigint, n bigint")
    return rows.groupBy("key").agg(F.sum("n").alias("n"))


def character_model(counts):
    """Log probability of a class after two others, interpolated; at most CLASSES**3."""
    found = counts.toArrow()
    three = np.zeros(CLASSES**3)
    three[found.column("key").to_numpy()] = found.column("n").to_numpy()
    three = three.reshape(CLASSES, CLASSES, CLASSES)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    single = (one + 1) / (one.sum() + CLASSES)
    after_one = (two + 5 * single) / (two.sum(axis=1, keepdims=True) + 5)
    after_two = (three + 5 * after_one) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(after_two).astype(np.float32)


def readings(token):
    """For each sign of a token the (meant, cost) it may have."""
    made = []
    for k, sign in enumerate(token):
        options = [(sign, 0.0)]
        options += [(letter, REPLACED) for letter in LOOKALIKES.get(sign, "")]
        if sign in BETWEEN:
            options.append(("", FILLED))
        if k and token[k - 1] == sign:
            options.append(("", REPEATED))
        made.append(options)
    return made


def viterbi(token, table):
    """The likeliest reading of a token, and its log probability."""

    def advance(context, meant):
        total = 0.0
        for byte in meant.encode("utf-8", "replace"):
            new = _LIST[byte]
            total += float(table[context[0], context[1], new])
            context = (context[1], new) if new else (0, 0)
        return context, total

    best = {(0, 0): (0.0, None)}
    for options in readings(token):
        after = {}
        for context, (value, path) in best.items():
            for meant, cost in options:
                to, gain = advance(context, meant)
                new = value + gain - cost
                if to not in after or new > after[to][0]:
                    after[to] = (new, (path, meant) if meant else path)
        best = after
    ended = [(value + float(table[c[0], c[1], 0]), path) for c, (value, path) in best.items()]
    value, path = max(ended, key=lambda e: e[0])
    letters = []
    while path:
        path, meant = path
        letters.append(meant)
    return "".join(reversed(letters)), value


_SPACED = re.compile(r"(?<!\S)(?:[^\s,;:?] ){2,}[^\s,;:?](?![^\s.,;:!?])")
_ODD = re.compile(r"([^\W\d_])\1\1|[0-9@$!|+({<€£*._~^/\\-][^\W\d_]|[^\W\d_][0-9@$|+({<€£]")
_LETTER = re.compile(r"[^\W\d_]")
_OUTER = " \t\n\x0b\x0c\r.,;:?!\"'()[]*%&#-_~"


class Restorer:
    """Texts as they were meant, in lower case, tokens between single blanks."""

    def __init__(self, table):
        self.decode = lru_cache(50_000)(lambda token: viterbi(token, table)[0])

    def _spaced(self, match):
        return self.decode(match.group()) if _LETTER.search(match.group()) else match.group()

    def __call__(self, text):
        text = text.lower()
        for sign in "\t\n\x0b\x0c\r\xa0":
            text = text.replace(sign, " ")
        text = _SPACED.sub(self._spaced, text)
        made, done = [], 0
        for match in _ODD.finditer(text):
            if match.start() < done:
                continue
            first = max(text.rfind(" ", done, match.start()) + 1, done)
            last = text.find(" ", match.end())
            last = len(text) if last < 0 else last
            token = text[first:last].rstrip(_OUTER).lstrip("\"'([*%&#-_~.,")
            made += [text[done:first], self.decode(token) if len(token) > 2 else token]
            done = last
        text = "".join([*made, text[done:]]) if made else text
        for sign in ".,;:!?\"'()[]*%&#":
            text = text.replace(sign, " ")
        return f" {text} "


def _features(text):
    """Words, and beginnings of longer words, of a restored text."""
    found = set(text.split())
    made = {f" {word} " for word in found if 1 < len(word) <= 40}
    for n in BEGINNINGS:
        made.update(f" {word[:n]}" for word in found if len(word) > n)
    return made


class Model:
    """The character model, the lexicon with its weights, and the logistic function."""

    def __init__(self, table, lexicon, line=None, constant=None):
        self.table, self.lexicon, self.line, self.constant = table, lexicon, line, constant

    def ready(self):
        """A function from a text to its four measures."""
        restore, automaton = Restorer(self.table), ahocorasick.Automaton()
        for feature, weight in self.lexicon:
            automaton.add_word(feature, (len(feature), weight))
        automaton.make_automaton()

        def measure(text):
            text = restore(text)
            hits = {}
            if self.lexicon:
                for end, (size, weight) in automaton.iter(text):
                    start = end - size
                    hits[start] = max(hits.get(start, 0.0), weight)
            if not hits:
                return 0.0, 0.0, 0.0, 0.0
            n = max(text.count(" ") - text.count("  "), 1)
            total = sum(hits.values())
            return max(hits.values()), math.log1p(len(hits)), math.log1p(total), min(len(hits) / n, 1.0)

        return measure

    def probability(self, measures):
        x = np.column_stack([np.ones(len(measures)), np.array(measures).reshape(-1, 4)])
        return 1 / (1 + np.exp(-np.clip(x @ self.line, -50, 50)))


def _logistic(measures, labels):
    """Weights by Newton's method, with a slight pull towards zero."""
    x = np.column_stack([np.ones(len(labels)), np.array(measures).reshape(-1, 4)])
    pull = np.diag([1e-3, 0.05, 0.05, 0.05, 0.05])
    line = np.zeros(5)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        slope = x.T @ (labels - p) - pull @ line
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull + 1e-6 * np.eye(5)
        line = line + np.linalg.solve(curve, slope)
    return line


def sampled(docs, labels, most=SAMPLE):
    """(doc_id, text, label, half) of at most ``most`` labelled ids, picked by hash."""
    wanted = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    share = most * 1.2 / max(wanted.count(), 1)
    order = F.xxhash64(F.lit("toxicity"), "doc_id")
    # Little more than the sample is sorted, however many labels there are.
    some = wanted.where((F.shiftrightunsigned(order, 1) / 2.0**63) < share)
    picked = some.withColumn("o", order).orderBy("o", "doc_id").limit(most)
    ids = tables.written(picked.select("doc_id", "label", F.pmod("o", F.lit(2)).alias("half")), "toxicity-ids")
    texts = docs.join(F.broadcast(ids), "doc_id").where("text is not null")
    texts = tables.written(_marked(texts), "toxicity-texts")
    # Copies would make chance look like evidence: one text counts per least shingle.
    kept = texts.select("doc_id", "least")
    for k in range(COPY_KEYS):
        kept = kept.groupBy(F.col("least")[k]).agg(F.min_by("least", F.struct("doc_id", "least")).alias("least"), F.min("doc_id").alias("doc_id"))
        kept = kept.select("doc_id", "least")
    kept = F.broadcast(kept.withColumnsRenamed({"doc_id": "i", "least": "l"}))
    same = (F.col("doc_id") == F.col("i")) & (F.col("least") == F.col("l"))
    return tables.written(texts.join(kept, same, "left_semi").drop("least"), "toxicity-sample")


def _marked(texts):
    """With ``least``: the least hashes of a text's five-word shingles by some orders."""

    def mark(batches):
        for batch in batches:
            data, offsets = words.utf8(batch.column("text"))
            held, bounds = words.shingles(*words.word_hashes(data, offsets))
            full = np.flatnonzero(np.diff(bounds))
            least = np.zeros((batch.num_rows, COPY_KEYS), np.uint64)
            for k in range(COPY_KEYS if len(held) else 0):
                least[full, k] = np.minimum.reduceat(words.mix(held + np.uint64(k)), bounds[:-1][full])
            column = pa.array(list(least.view(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "least"])

    kinds = ", ".join(f"{name} {kind}" for name, kind in texts.dtypes)
    return texts.mapInArrow(mark, f"{kinds}, least array<bigint>")


def _lexicon(sample, table, most=LEXICON):
    """[(feature, weight)] of what stands in texts of label 1 too often for chance."""
    held = sample.sparkSession.sparkContext.broadcast(table)

    def count(batches):
        restore, tallies = Restorer(held.value), (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                tallies[label].update(_features(restore(text)))
        rows = [(f, n, int(label == 1)) for label in (0, 1) for f, n in tallies[label].items()]
        columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "n", "label"])

    toxic, clean = sample.agg(
        F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    ).first()
    if not toxic or not clean:
        return []
    one, zero = (F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)) for k in (1, 0))
    rows = sample.mapInArrow(count, "feature string, n bigint, label int")
    counted = rows.groupBy("feature").agg(one.alias("a"), zero.alias("b"))
    counted = tables.written(counted, "toxicity-features")
    tried = counted.count()
    # Chernoff's bound on seeing so many by chance, against how many were tried.
    share, usual = F.col("a") / (F.col("a") + F.col("b")), toxic / (toxic + clean)
    rest = F.when(F.col("b") > 0, (1 - share) * F.log((1 - share) / (1 - usual))).otherwise(0.0)
    surprise = (F.col("a") + F.col("b")) * (share * F.log(share / usual) + rest)
    weight = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (clean + 1))
    kept = counted.where((F.col("a") > 2) & (share > usual)).select(
        "feature", weight.alias("weight"), surprise.alias("surprise")
    )
    kept = kept.where((F.col("surprise") > math.log(max(tried, 1))) & (F.col("weight") > 2.5))
    kept = kept.orderBy(F.desc("surprise"), "feature").limit(most)
    return [(r.feature, float(r.weight)) for r in kept.collect()]


def fit(docs, labelled, most=SAMPLE):
    """A model; ``labelled`` is (doc_id, label 0 or 1) of the rows to learn from."""
    docs = tables.documents(docs)
    sample = sampled(docs, labelled, most)
    share = sample.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        return Model(None, [], constant=0.5 if share is None else float(share))
    table = character_model(character_counts(docs))
    model = Model(table, _lexicon(sample.where("half = 0"), table))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches):
        measure = held.value.ready()
        for batch in batches:
            made = [measure(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([m[i] for m in made], pa.float64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *columns], ["label", *"abcd"])

    kind = "label int, a double, b double, c double, d double"
    # A sample's measures: SAMPLE rows of five numbers at most a copy of a text.
    rows = sample.where("half = 1").mapInArrow(measured, kind).toPandas()
    labels = rows["label"].to_numpy(float)
    if len(set(labels)) < 2:
        model.constant = float(share)
    else:
        model.line = _logistic(rows[[*"abcd"]].to_numpy(), labels)
        # What is said about a lexicon learnt elsewhere also holds for one learnt from more.
        model.lexicon = _lexicon(sample, table)
    return model


def score(docs, model):
    """Per row of ``docs``: doc_id, score (0 to 1)."""
    docs = tables.documents(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        model, measure = held.value, None
        for batch in batches:
            if model.constant is not None:
                made = np.full(batch.num_rows, model.constant)
            else:
                measure = measure or model.ready()
                texts = batch.column("text")
                made = model.probability([measure(texts[i].as_py() or "") for i in range(len(texts))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.float64())], ["doc_id", "score"])

    return docs.mapInArrow(scored, "doc_id bigint, score double")


def trained(docs, labels, learn):
    """The model learnt from the ids with a label for which ``learn`` holds."""
    label = F.col("toxic").cast("int").alias("label")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), label)
    return fit(docs, known.where(learn & F.col("label").isin(0, 1)))
