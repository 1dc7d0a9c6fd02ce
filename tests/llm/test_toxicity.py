"""The noisy channel against all readings, scores against held-out labels."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.llm import queries, toxicity

SF = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def table(spark):
    return toxicity.character_model(toxicity.character_counts(spark.read.parquet(f"{SF}/documents.parquet")))


def value(text, table):
    """Log probability of a text, letter by letter."""
    total, context = 0.0, (0, 0)
    for byte in [*text.encode(), 32]:
        new = toxicity._LIST[byte]
        total += float(table[(*context, new)])
        context = (context[1], new) if new else (0, 0)
    return total


@pytest.mark.parametrize("token", ["1d10t", "l0oser", "s c u m", "m*0*r", "tr@@sh", "$tup1d", "ö9a", "a-b"])
def test_viterbi_finds_the_best_of_all_readings(table, token):
    every = []
    for choice in itertools.product(*toxicity.readings(token)):
        text = "".join(meant for meant, _ in choice)
        every.append((value(text, table) - sum(cost for _, cost in choice), text))
    found, score = toxicity.viterbi(token, table)
    best = max(every)
    assert score == pytest.approx(best[0], abs=1e-3)
    assert found in {text for v, text in every if v > best[0] - 1e-3}


def test_model_is_a_distribution_over_counted_trigrams(spark, table):
    assert np.allclose(np.exp(table.astype(np.float64)).sum(axis=2), 1, atol=1e-3)
    rows = spark.createDataFrame([(1, "ab, ab"), (2, None), (3, "b")], "doc_id int, text string")
    c = {r.key: r.n for r in toxicity.character_counts(rows).collect()}
    n = toxicity.CLASSES

    def key(x, y, z):
        return (x * n + y) * n + z

    assert (c[key(0, 0, 1)], c[key(0, 1, 2)], c[key(1, 2, 0)], c[key(0, 0, 2)]) == (2, 2, 2, 1)


def test_restoring_leaves_plain_text_alone(table):
    restore = toxicity.Restorer(table)
    for text in ("the and of 2024 was good", "4958536470539468", "a b", "größer als ¿qué?", "", "12 34"):
        assert restore(text).split() == [w.strip("?") for w in text.lower().split()]
    assert restore("x" * 100_000 + " ok").endswith(" ok ")


def test_disguised_words_are_found(spark):
    """Held-out labels; and the same texts with their letters replaced and spaced."""
    found = queries.op13_toxicity(spark, LARGE)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r.doc_id: r for r in found.collect()}
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    held = [(rows[i].predicted, toxic) for i, toxic in labels.items() if rows[i].held_out]
    assert np.mean([p for p, t in held if t]) > 0.8
    assert np.mean([p for p, t in held if not t]) < 0.04

    model = toxicity.trained(docs, spark.read.parquet(f"{LARGE}/labels.parquet"), F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    measure, rnd = model.ready(), random.Random(13)
    signs = str.maketrans({"o": "0", "i": "1", "e": "3", "s": "$", "a": "@"})
    caught = tried = 0
    for row in docs.where("lang = 'en' and doc_id % 5 = 0").collect():
        if rows[row.doc_id].predicted and rows[row.doc_id].held_out:
            kind = rnd.randrange(2)
            words = row.text.split(" ")
            hard = [w.translate(signs) if kind else w[:1] + w[1:2] * 3 + w[2:] for w in words]
            caught += model.probability([measure(" ".join(hard))])[0] >= 0.3
            tried += 1
    assert tried > 5 and caught / tried > 0.7


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, label string, score string, half string"
    rows = [(k, t, *"xyz") for k, t in [(1, None), (2, ""), (3, "fine words"), (3, "fine words"), (None, "vile!")]]
    rows += [(100 + k, f"you vile man {k}" if k % 2 else f"you good man {k}", *"xyz") for k in range(80)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    labels = [(100 + k, k % 2) for k in range(80)] + [(100, 1), (101, None), (None, 1)]
    labels = spark.createDataFrame(labels, "doc_id int, toxic int")
    model = toxicity.trained(docs, labels, F.lit(True))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows)
    low = [r.score for r in found if r.doc_id in (1, 2, 3)]
    assert len(low) == 4 and max(low) < 0.3
    assert [r.score > 0.3 for r in found if r.doc_id is None] == [True]
    assert toxicity.score(docs.where("doc_id < 0"), model).isEmpty()
    for toxic, share in ((None, 0.5), (1, 1.0), (0, 0.0)):
        some = labels.where("doc_id > 101").withColumn("toxic", F.lit(toxic).cast("int"))
        only = toxicity.trained(docs, some, F.lit(True))
        assert {r.score for r in toxicity.score(docs, only).collect()} == {share}
