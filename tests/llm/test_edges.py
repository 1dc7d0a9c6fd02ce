"""Nulls, empty and long texts, repeated rows, empty tables, clashing names."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tributary.llm import ann, bpe, classifier, dedup, language, lm, ordering, packing, pii, quality

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint,"
    " m string, score string, ids string, pii string, kept_ string, region string"
)
SENTENCE = "one two three four five six seven eight nine ten. "
ROWS = [
    (1, None, None, None),
    (2, "", "en", None),
    (3, " \n\t ", None, "s"),
    (4, SENTENCE * 4000, "en", "s"),
    (5, "Write to a@b.co, now please my dear friend of mine.", "en", "s"),
    (5, "Write to a@b.co, now please my dear friend of mine.", "en", "s"),
    (5, "quite another text under the same number, that is all", "fr", "s"),
    (None, "a row without a number", "en", "s"),
    (6, "<|endoftext|> x" + "y" * 5000, "de", "t"),
    (7, "é ü 漢字 🙂 " * 30, "xx", "t"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 0, *"abcdef") for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = 99")


def test_bpe(docs, none):
    coded = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    assert coded.where("decoded <> coalesce(text, '')").isEmpty()
    assert coded.count() == len(ROWS)
    assert set(docs.columns) <= set(coded.columns)
    assert bpe.decode(bpe.encode(none, VOCABULARY), VOCABULARY).isEmpty()


def test_dedup(docs, none):
    rows = dedup.near_duplicates(docs).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows if r.n_shingles == 0}
    assert set(by_id) == {1, 2, 3} and all(r.kept for r in by_id.values())
    assert [r.kept for r in rows if r.doc_id is None] == [True]
    assert dedup.near_duplicates(none).isEmpty()


def test_quality(docs, none):
    rows = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert rows[1].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert rows[4].n_words == rows[4].n_repeat_words == 40_000
    assert quality.judged(none).isEmpty()
    kept = quality.kept_only(docs)
    assert kept.columns == docs.columns
    assert quality.kept_only(none).isEmpty()


def test_pii(docs, none):
    found = pii.found(docs, name="spans").select("doc_id", F.size("spans").alias("n"))
    assert sum(r.n for r in found.collect()) == 2
    masked = pii.redacted(docs)
    assert masked.columns == docs.columns
    assert masked.where(F.contains("text", F.lit("[EMAIL]"))).count() == 2
    assert pii.redacted(none).isEmpty()


def test_language(docs, none):
    model = language.fit(docs.select("doc_id", "text", "lang"))
    assert "en" in model.names
    kept = language.accepted_only(docs, model)
    assert kept.columns == docs.columns and kept.count() <= len(ROWS)
    assert language.accepted_only(none, model).isEmpty()
    blank = language.fit(none.select("doc_id", "text", "lang"))
    assert language.accepted_only(docs, blank).isEmpty()


def test_classifier(spark, docs, none):
    labels = spark.createDataFrame(
        [(4, 0), (5, 1), (None, 1), (6, None), (7, 1)], "doc_id bigint, quality int"
    )
    network = classifier.trained(docs, labels, F.lit(True))
    rows = classifier.score(docs, network).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    unlabelled = classifier.trained(docs, labels.where("doc_id = 99"), F.lit(True))
    assert {r.score for r in classifier.score(docs, unlabelled).collect()} == {0.5}
    assert classifier.score(none, network).isEmpty()


def test_language_model(docs, none):
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    rows = lm.score(docs, fold).collect()
    assert len(rows) == len(ROWS)
    empty = next(r for r in rows if r.doc_id == 1)
    assert empty.n_tokens == 1 and empty.score < 0
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert lm.score(none, fold).isEmpty()


def test_packing(docs, none):
    rows = packing.pack(docs, VOCABULARY, window=64, shard=3).collect()
    known = bpe.codec(VOCABULARY)
    texts = {}
    for doc, text, *_ in ROWS:
        texts.setdefault(doc, []).append(known.encode([text])[0] + b"\0\0\0\0")
    total = sum(len(x) // 4 for xs in texts.values() for x in xs)
    assert sum(r.length for r in rows) == total
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u2").astype("<u4")
        assert zlib.crc32(ids) == r.ids_crc32 and len(ids) == r.length
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(none, VOCABULARY).isEmpty()


def test_training_order(spark, docs, none, tmp_path):
    folder = f"file://{tmp_path}/order"
    index = ordering.materialise(docs, VOCABULARY, 32, per_shard=100, key=5, folder=folder)
    rows = sorted(index.collect())
    assert [r.slot for r in rows] == list(range(len(rows)))
    held = sorted(ordering.read(spark, folder).collect())
    assert [r.slot for r in held] == [r.slot for r in rows]
    assert sorted(r.number for r in rows) == list(range(len(rows)))
    ids = {r.number: h.ids for r, h in zip(rows, held)}
    flat = [i for n in sorted(ids) for i in ids[n]]
    known = bpe.codec(VOCABULARY)
    assert known.decode(flat).count("Write to a@b.co, now please") == 2
    part = sorted(ordering.read(spark, folder, 90, 210).collect())
    assert part == held[90:210]
    assert ordering.materialise(none, VOCABULARY, folder=f"{folder}-none").isEmpty()


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]),
        (4, None), (5, []), (6, [0.0, -0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]),
        (None, [1.0, 1.0]), (20, [1.0, 2.0, 3.0]), (40, [0.0, 2.0]), (60, None),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, v string")
    got = sorted(ann.nearest(df, F.col("vec_id") % 20 == 0, k=3).collect())
    assert [tuple(r) for r in got] == [
        (0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 0.0),
        (40, 1, 3, 2.0), (40, 2, 0, 0.0), (40, 3, 1, 0.0),
    ]
    assert ann.nearest(df.where("vec_id = 99"), F.col("vec_id") % 20 == 0).isEmpty()
