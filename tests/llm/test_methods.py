"""Each operator against a plain version of it, on small tables."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import canonical
from tributary.llm import ann, bpe, classifier, dedup, language, lm, oracle, ordering, packing, pii, queries

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def test_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    held = {q.__name__: q for q in queries.QUERIES}
    for name, sql in oracle.statements().items():
        assert canonical(held[name](spark, SF).toPandas()) == canonical(duck.sql(sql).df()), name


def test_encoder_equals_the_tokenizers_library(texts):
    rnd = random.Random(3)
    signs = [*"ab'st reLl1 2\n\t \x0b\x85 é漢.,!", "<|endoftext|>", "  ", "\r\n", "　", "'ll"]
    odd = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    odd += ["a" * 999, "ab" * 500, " " * 99 + "x", *list(texts.values())[:100]]
    own, theirs = bpe.Codec(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for text, raw in zip(odd, own.encode(odd)):
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids
        assert own.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
    assert own.decode([0, 10**6, -1]) == own.decode([0])


def shingles(text):
    words = WORD.findall(text.translate(LOWER))
    runs = (tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))
    return set(runs) if words else set()


def test_near_copies_at_the_border_are_all_linked(spark):
    rnd = random.Random(7)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(104)]
    rows = []
    # Runs of the base that share just over, or just under, three quarters.
    for k in range(40):
        own = [f"x{k}y{i}" for i in range(20)]
        rows.append((k, " ".join(base[: 104 - k % 20] + own[: k % 20])))
    passage = " ".join(f"p{i}" for i in range(30))
    for k in range(40, 240):
        rows.append((k, passage + " " + " ".join(f"z{rnd.randrange(10**6)}" for _ in range(25))))
    parent = list(range(len(rows)))
    sets = [shingles(t) for _, t in rows]

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    made = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in dedup.near_duplicates(made).collect()}
    assert got == {k: find(k) for k in range(len(rows))}


def test_components_of_a_long_chain(spark):
    order = list(range(300))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint")
    assert {r.component for r in dedup.components(links).collect()} == {0}


def luhn(digits):
    twice = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def test_personal_data_equals_plain_patterns(spark, texts):
    odd = ["x@y..z", "a@b.co_d@e.fr a@b.c-.d--", "1.2.3.4.5 256.1.1.1 0001.002.03.255",
           "4111 1111 1111 1111", "4111-1111--1111-1111 4111111111111111  12", "🙂 a@b.co 10.0.0.1",
           "+1 (454) 555-9913 +12", "1 2 3 " * 9000, "a.b" * 9000 + "@", "a@b" + ".c" * 9000]
    texts = texts | {1000 + i: t for i, t in enumerate(odd)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    got = pii.found(df).select("doc_id", pii.listed(F.col("pii")).alias("s")).collect()
    plain = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m.split("."))) <= 255),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
    ]
    for row in got:
        wanted = sorted(
            (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
            for rank, (kind, pattern, good) in enumerate(plain)
            for m in re.finditer(pattern, texts[row.doc_id])
            if good(m.group())
        )
        base = [s for s in row.s.split(",") if s.split(":")[0] in pii.BASE]
        assert base == [w[2] for w in wanted]


def test_checksums_and_context_decide_on_further_kinds(spark):
    rows = ["DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "my ssn 123-45-6789",
            "part 123-45-6789", "phone 030 1234567", "code 030 1234567"]
    df = spark.createDataFrame([(t,) for t in rows], "text string").coalesce(1)
    kinds = pii.found(df).select(F.transform("pii", lambda s: s.kind).alias("k")).collect()
    assert [r.k for r in kinds] == [["iban"], [], ["ssn"], [], ["tel"], []]


def test_ibans_end_where_their_country_says(spark):
    rows = {
        "DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX": "DE89 3704 0044 0532 0130 00",
        "to DE89370400440532013000 2024 now": "DE89370400440532013000",
        "GB82 WEST 1234 5698 7654 32 I live": "GB82 WEST 1234 5698 7654 32",
        "NO93 8601 1117 947 DE89 3704 0044 0532 0130 00": "NO93 8601 1117 947|DE89 3704 0044 0532 0130 00",
        "BE12 3456 DE89 3704 0044 0532 0130 00": "DE89 3704 0044 0532 0130 00",
        "DE89 3704 0044 0532 0130 001": "",
        "DE88 3704 0044 0532 0130 00 BIC": "",
    }
    check = 98 - int("".join(str(int(c, 36)) for c in "12345678901234XX00")) % 97
    rows[f"XX{check:02d} 1234 5678 9012 34 AND MORE"] = f"XX{check:02d} 1234 5678 9012 34"
    df = spark.createDataFrame([(t,) for t in rows], "text string").coalesce(1)
    found = pii.found(df).withColumn("pii", F.filter("pii", lambda s: s.kind == "iban")).collect()
    assert {r.text: "|".join(r.text[s.start : s.end] for s in r.pii) for r in found} == rows
    masked = [r.text for r in pii.redacted(df).collect()]
    assert masked[0] == "[IBAN] BIC COBADEFFXXX"


def test_language_model_equals_counting(docs, texts):
    fold = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    tokens = {i: [*WORD.findall(t.translate(LOWER)), "\0"] for i, t in texts.items()}
    train = {i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2}
    words = Counter(w for i in train for w in tokens[i])
    pairs = Counter(p for i in train for p in zip(["\1", *tokens[i]], tokens[i]))
    n, k = sum(words.values()), 4.0
    for row in lm.score(docs, fold, strength=k).collect():
        base = path = 0.0
        for u, w in zip(["\1", *tokens[row.doc_id]], tokens[row.doc_id]):
            p = (words[w] + 1) / (n + len(words) + 1)
            before = len(train) if u == "\1" else words[u]
            base, path = base + math.log10(p), path + math.log10((pairs[u, w] + k * p) / (before + k))
        assert row.base_score == pytest.approx(base) and row.score == pytest.approx(path)
        assert row.n_known == sum(words[w] > 0 for w in tokens[row.doc_id])
        assert (row.n_tokens, row.train_tokens) == (len(tokens[row.doc_id]), n)


def test_feistel_is_a_permutation_that_the_key_picks():
    for n in (1, 2, 3, 5, 1000, 4097):
        slots = ordering.permuted(np.arange(n), n, 3)
        assert sorted(slots) == list(range(n))
    assert (ordering.permuted(np.arange(1000), 1000, 3) != ordering.permuted(np.arange(1000), 1000, 4)).any()


def test_packing_pads_little_and_puts_related_texts_together(spark):
    rows = [(i, " ".join(f"{'red' if i % 2 else 'blue'}{j % 9}" for j in range(40 + i % 7))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = packing.pack(df, VOCABULARY, window=256).collect()
    mates = {}
    for r in got:
        mates.setdefault(r.sequence_id, []).append(r.doc_id % 2)
    mixed = sum(len(set(m)) > 1 for m in mates.values())
    total = sum(r.length for r in got)
    assert len(mates) <= -(-total // 256) + 1 and mixed <= 1


def test_packing_puts_related_texts_of_many_shards_together(spark):
    rnd = random.Random(5)

    def word():
        return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))

    common, topics = [word() for _ in range(30)], [[word() for _ in range(12)] for _ in range(40)]
    rows = []
    for i in range(1200):
        own = rnd.choices(topics[i % 40], k=25) + rnd.choices(common, k=25)
        rows.append((i, " ".join(rnd.sample(own, 50))))
    rows += [(i, "the very same words again and again") for i in range(1200, 1700)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = packing.pack(df, VOCABULARY, window=512, shard=100).collect()
    mates, shards = {}, {}
    for r in got:
        mates.setdefault(r.sequence_id, []).append(r.doc_id % 40 if r.doc_id < 1200 else 40)
        shards.setdefault(r.sequence_id >> 32, set()).add(r.doc_id)
    assert len(shards) >= 17 and max(map(len, shards.values())) <= 150
    alike = [Counter(m).most_common(1)[0][1] / len(m) for m in mates.values() if len(m) > 1]
    assert np.mean(alike) >= 0.8


def test_nearest_neighbours_recall(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, size=(3000, 1))
    base[1::7] = base[0]
    base = base.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "vec_id bigint, embedding array<float>")
    got = {}
    for r in sorted(ann.nearest(df, F.col("vec_id") % 20 == 0).collect()):
        got.setdefault(r.query_id, []).append(r.vec_id)
    exact = base.astype(np.float64) @ base.astype(np.float64).T
    hits = []
    for q in range(0, 3000, 20):
        row = exact[q].copy()
        row[q] = -np.inf
        best = np.lexsort((np.arange(3000), -row))[:20]
        hits.append(len(set(best) & set(got[q])) / 20)
    assert np.mean(hits) >= 0.9


def test_classifier_on_held_out_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    network = classifier.trained(docs, labels, learn)
    held = classifier.score(docs, network).join(labels, "doc_id").where(~learn)
    right = held.agg(F.avg(((F.col("score") >= 0.7) == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right >= 0.95


def test_language_of_documents_and_pages(spark, docs):
    model = language.fit(docs.select("doc_id", "text", "lang"))
    pages = language.of_pages(spark.read.parquet(f"{SF}/pages.parquet"))
    rows = language.posterior(pages, model).collect()
    agree = sum(r.declared == r.language for r in rows) / len(rows)
    assert agree >= 0.9 and all(r.accepted for r in rows)


def test_texts_of_no_learnt_language_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs.select("doc_id", "text", "lang"))
    rnd = random.Random(9)
    cyrillic, han = [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x5200)]
    signs = ["abcdefghijklmnopqrstuvwxyz", "0123456789", cyrillic, han]
    odd = []
    for i in range(200):
        text = " ".join("".join(rnd.choices(signs[i % 4], k=rnd.randint(2, 9))) for _ in range(40))
        odd.append((-1 - i, text, "en", "web"))
    own = docs.where("lang is not null and size(split(text, ' ')) >= 20")
    own = own.select("doc_id", "text", "lang", "source")
    got = language.accepted_only(own.union(spark.createDataFrame(odd, own.schema)), model)
    kept = [r.doc_id for r in got.select("doc_id").collect()]
    assert not [i for i in kept if i < 0]
    assert len(kept) >= 0.99 * own.count()


def test_evidence_of_a_host_decides_where_the_text_does_not(spark, docs):
    model = language.fit(docs.select("doc_id", "text", "lang"))
    french = docs.where("lang = 'fr'").select("text").limit(20)
    rows = french.withColumn("n", F.lit(0)).union(spark.createDataFrame([("", 1)], "text string, n int"))
    rows = rows.withColumns({"declared": F.lit(None), "host": F.lit("a.fr"), "suffix": F.lit("fr")})
    (row,) = language.posterior(rows, model).where("n = 1").collect()
    assert row.language == "fr" and row.accepted


def test_near_duplicates_go_by_row(spark):
    rnd = random.Random(4)
    a, b, c, d = (" ".join(f"{s}{rnd.randrange(10**6)}" for _ in range(40)) for s in "abcd")
    rows = [(3, a), (5, b), (5, a), (7, c), (7, c), (8, c), (9, d), (5, d + " more"), (2, ""), (None, a)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = corpus_pipeline.near_duplicates(spark, df, SF)
    assert got.columns == df.columns
    wanted = [(3, a), (5, b), (7, c), (5, d + " more"), (2, ""), (None, a)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))


def test_pipeline(spark, docs, texts):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "language_id", "near_duplicates", "personal_data", "packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in rows}
    sets = {}
    for i in kept:
        sets.setdefault(frozenset(shingles(texts[i])), []).append(i)
    assert all(len(x) == 1 for x in sets.values())
    assert sum(labels.get(i) == 0 for i in kept) <= 1
