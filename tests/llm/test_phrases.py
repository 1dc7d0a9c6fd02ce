"""Phrase mining against plain counting and the SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check import canonical
from tributary.llm import oracle, phrases, queries

SCHEMA = "doc_id bigint, text string, lang string, f string, fp string, n string, m string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall("[^\x20\x09]+", piece)


def plain(rows, often, best):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            total[lang] += len(words)
            f.update((lang, *words[i : i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    f = {k: v for k, v in f.items() if v >= often}
    made = []
    for (lang, *words), a in f.items():
        if len(words) < 2:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        inside = any(
            p[0] == lang and v >= a and len(p) > len(words) + 1 and f" {' '.join(words)} " in f" {' '.join(p[1:])} "
            for p, v in f.items()
        )
        if not inside:
            score, _, left, right = min(cuts)
            made.append((lang, " ".join(words), a, left, right, total[lang], score))
    made.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    counts, out = Counter(), []
    for row in made:
        counts[row[0]] += 1
        if counts[row[0]] <= best:
            out.append((row[0], counts[row[0]], *row[1:]))
    return out


def fixture():
    rnd = random.Random(12)
    rows = []
    for lang in ("en", "de", None, ""):
        texts = []
        for _ in range(60):
            words = rnd.choices(["The", "a", "of", "no", "x", "École", "b-c", "a\xa0b"], k=rnd.randint(0, 80))
            ends = rnd.choices([" ", " ", "  ", "\t", ". ", "\n", "; ", "\x0b"], k=len(words))
            texts.append("".join(w + e for w, e in zip(words, ends)))
        texts += ["new york city hall " * 30] * 3 + ["a a a a a a a a", None, "", " \t", "..", "q" * 5000]
        rows += [(t, lang) for t in texts]
    rows.append(("Long one without a mark " * 20_000, "fr"))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, *r, *"wxyz") for k, r in enumerate(fixture())]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("bound", [phrases.BOUND, 0])
def test_equals_plain_counting(docs, bound):
    found = phrases.collocations(docs, often=25, best=40, bound=bound).collect()
    wanted = plain(fixture(), 25, 40)
    assert sorted(tuple(r[n] for n in NAMES) for r in found) == sorted(wanted)


def test_query_equals_sql(spark, docs, tmp_path):
    # The SQL copies a whole text per word, so the longest one is left to the test above.
    some = docs.where("text is null or length(text) < 100000")
    some.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6)))).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = queries.op12_phrases(spark, str(tmp_path)).toPandas()
    assert len(found) > 20
    assert canonical(found) == canonical(duck.sql(oracle.statements()["op12_phrases"]).df())


def batch():
    rows = fixture()
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array(["und" if r[1] is None else r[1] for r in rows])], ["text", "lang"]
    )


def occurrences(rows, lengths=range(1, 6)):
    counted = Counter()
    for text, lang in rows:
        for words in pieces(text):
            for m in lengths:
                starts = range(len(words) - m + 1)
                counted.update(("und" if lang is None else lang, m, " ".join(words[i : i + m])) for i in starts)
    return counted


@pytest.mark.parametrize("size", [phrases.words.SLICE, 300])
@pytest.mark.parametrize("bits", [64, 4])
def test_runs_are_told_apart_by_text(monkeypatch, size, bits):
    """Also in small slices, and with fingerprints so short that nearly all collide."""
    monkeypatch.setattr(phrases.words, "SLICE", size)
    tally = {}
    for part in phrases._flat(batch()):
        runs = phrases.Runs(*part)
        for n, places, keys in phrases._candidates(runs, range(1, 6), {}):
            phrases._compare(runs, n, places, keys & np.uint64(2**bits - 1), tally)
    found = Counter()
    for (lang, n, _, text), f in tally.items():
        found[lang, n, text.decode()] += f
    assert found == occurrences(fixture())


def test_collisions_show_in_the_residues():
    parts, waiting = list(phrases._flat(batch())), []
    for part in parts:
        runs = phrases.Runs(*part)
        for n, places, keys in phrases._candidates(runs, [1, 2], {}):
            waiting.append((keys & np.uint64(3), runs.residues(places, n), runs.pointers[places]))
    made = phrases._added(waiting, {"en": 5}).to_pylist()
    assert sum(row["f"] for row in made[:4]) == sum(occurrences(fixture(), [1, 2]).values())
    assert (made[4]["fp"], made[4]["lang"], made[4]["f"]) == (None, "en", 5)
    # No residue of a run is the mean where runs collided.
    for row in made[:4]:
        assert not any((k == row["fp"]).any() and (r[k == row["fp"]] * row["f"] == row["residues"]).any()
                       for k, r, _ in [(k.view(np.int64), r.astype(np.int64), p) for k, r, p in waiting])


@pytest.mark.parametrize("bound", [phrases.BOUND, 0])
def test_collided_runs_are_counted_by_text(spark, docs, bound):
    found = phrases._frequent(docs.fillna("und", "lang"), [2], {}, 25)
    rows = phrases._recounted(docs.fillna("und", "lang"), {}, found.where("fp is not null").select("fp"), 25, bound)
    wanted = {key: f for key, f in occurrences(fixture(), [2]).items() if f >= 25}
    assert {(r.lang, r.n, r.phrase): r.f for r in rows.collect()} == wanted


def test_pointers_give_their_runs(docs):
    docs = docs.fillna("und", "lang")
    for bound in (phrases.BOUND, 0):
        found = phrases._frequent(docs, [3], {}, 25).where("fp is not null")
        texts = phrases._resolved(docs, found, bound).select("fp", "lang", "phrase", "residue").distinct()
        rows = found.drop("lang").join(texts, "fp").collect()
        assert all(r.residue * r.f == r.residues for r in rows)
        wanted = {key: f for key, f in occurrences(fixture(), [3]).items() if f >= 25}
        assert {(r.lang, 3, r.phrase): r.f for r in rows} == wanted


def test_fingerprints_are_polynomials():
    data = np.frombuffer("él niño " .encode() * 30_000, np.uint8)
    starts = np.array([0, 9, 70_000])
    ends = np.array([9, 9, 200_000])
    for p in phrases._POLYNOMIALS:
        for i, j, found in zip(starts, ends, p.runs(data, starts, ends).tolist()):
            value = 0
            for byte in reversed(data[i:j].tolist()):
                value = (value * p.base + byte + 1) % p.prime
            assert value == found


def test_empty_table_and_scores_beyond_64_bits(spark, docs):
    assert phrases.collocations(docs.where("doc_id < 0")).isEmpty()
    big = 3 * 10**12
    rows = [("en", 0, "", big), ("en", 1, "p", 10**9), ("en", 1, "q", 2 * 10**9), ("en", 2, "p q", 7 * 10**8)]
    counted = spark.createDataFrame(rows, "lang string, n int, phrase string, f bigint")
    row = phrases.scored(counted).select("l", "r", F.col("score")).first()
    assert tuple(row) == (10**9, 2 * 10**9, 1000 * 7 * 10**8 * big // (10**9 * 2 * 10**9))
