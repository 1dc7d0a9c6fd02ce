"""Track matching in texts without blanks, against the pattern per term and text."""

import random
import re

from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators import tweets

REGISTRY = "type string, term string, channel_id bigint, river_id bigint"


def held(token, chunk):
    """A token hits between ASCII word bounds, or as the whole chunk."""
    chunk = chunk.translate(str.maketrans(text.UPPER, text.LOWER))
    bound = f"(?:{text.RUN_EDGE})"
    return chunk == token or re.search(bound + re.escape(token) + bound, chunk) is not None


def test_windows_agree_with_the_pattern(spark):
    rnd = random.Random(6)
    signs = [*"ab_1+.#é", "aa", "++", "long" * 14]
    texts = ["".join(rnd.choices(signs, k=rnd.choice([3, 20, 150, 600]))) for _ in range(120)]
    tokens = {"a", "b", "a+", "+a", "++", "a.b", "é", "aa#", "#", "_", "_+", "long" * 14, "aé", "..", "a+b"}
    for t in texts:
        for _ in range(3):
            at = rnd.randrange(len(t))
            tokens.add(t[at : at + rnd.choice([1, 2, 5, 30, 59, 60])])
    tokens = sorted(t for t in tokens if t and len(t) <= text.MAX_TERM)
    registry = spark.createDataFrame([("track", t, 1, 1) for t in tokens], REGISTRY)
    drops = spark.createDataFrame(list(enumerate(texts)), "id bigint, droplet_raw string")
    found = {(r.id, r.term) for r in tweets.track_match(drops, registry).collect()}
    assert found == {(k, t) for k, x in enumerate(texts) for t in tokens if held(t, x)}


def test_keys_grow_with_the_text_and_not_with_its_square(spark):
    def size(n):
        row = spark.range(1).select(F.repeat(F.lit("a."), n // 2).alias("t"))
        keys = row.select(F.inline(text.match_keys(F.col("t"))))
        return keys.agg(F.sum(F.octet_length("key") + F.coalesce(F.octet_length("context"), F.lit(0)))).first()[0]

    small, large = size(10_000), size(100_000)
    assert large < 11 * small and large < 100_000 * 10


def test_a_long_text_without_blanks(spark):
    filler = "x.y-" * 25_000
    registry = spark.createDataFrame(
        [("track", t, 1, 1) for t in ("c++", "c+", "needle", "eedle", "x.y-needle", "end!")], REGISTRY
    )
    drops = spark.createDataFrame([(1, f"{filler}needle-c++{filler}end!")], "id bigint, droplet_raw string")
    found = sorted(r.term for r in tweets.track_match(drops, registry).collect())
    # A symbol at the end of a longer chunk has no word bound behind it.
    assert found == ["c++", "needle", "x.y-needle"]


def test_words_of_a_text_are_keys_once(spark):
    """words are cut from the whole text; only chunks with symbols are gone through."""
    value = "Cat, cat. (CAT) cat; dog café " + "w" * 70 + " x"
    row = spark.createDataFrame([(value,)], "t string")
    rows = row.select(F.inline(text.text_keys(F.col("t")))).collect()
    assert sorted(r.key for r in rows if r.chunk is None) == ["caf", "cat", "dog", "x"]
    assert sorted(r.chunk for r in rows if r.key is None) == ["(CAT)", "Cat,", "café", "cat.", "cat;"]
    keys = row.select(F.inline(text.match_keys(F.lit("AÉb.c")))).collect()
    assert sorted(map(tuple, keys)) == [(k, "aÉb.c") for k in (".", "a", "b", "c", "É")]
