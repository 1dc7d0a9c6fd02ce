"""Lists that many drops share are made text once and stand in a file once, not once per drop."""

from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

from tributary.checks import entries
from tributary.operators import feeds, scale, tweets

LISTS = "key string, part bigint, river_id string, channel_ids string"


def _held(spark):
    """Five lists in 8 parts each, and drops of them, one with most."""
    lists = spark.createDataFrame(
        [(f"k{k}", p, f"{k}", f"{k}/{p}/" + "c" * 40_000) for k in range(5) for p in range(8)], LISTS
    )
    key = F.when(F.col("id") % 10 < 7, "k0").otherwise(F.concat(F.lit("k"), (F.col("id") % 6).cast("string")))
    rows = spark.range(3_000).select("id", key.alias("key"))
    # Ids may repeat; a key may be null, or of no list.
    return rows.unionByName(rows.where("id < 3")).unionByName(spark.range(2).select("id", F.lit(None).alias("key"))), lists


def test_a_file_holds_few_lists_and_each_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scale, "LIST_BYTES", 1 << 10)
    rows, lists = _held(spark)
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    out = scale.dealt_lists(rows, lists, "key", ["id"], most=500)
    out.select("id", "part", "channel_ids").write.parquet(f"{tmp_path}/out")

    got = spark.read.parquet(f"{tmp_path}/out").select("id", "part", F.substring("channel_ids", 1, 4).alias("c"))
    want = Counter(
        (r.id, p, f"{r.key[1]}/{p}/") for r in rows.collect() if r.key and r.key < "k5" for p in range(8)
    )
    assert Counter((r.id, r.part, r.c) for r in got.collect()) == want
    # 20,000 rows of 40 KB are 900 MB; each of 40 lists may come once for each of its tasks.
    assert sum(f.stat().st_size for f in Path(f"{tmp_path}/out").glob("*.parquet")) < 2_000_000
    kinds = spark.read.parquet(f"{tmp_path}/out").groupBy(F.input_file_name()).agg(F.countDistinct("channel_ids").alias("n"))
    assert max(r.n for r in kinds.collect()) < 12


def test_lists_are_made_text_before_drops_get_them(spark, monkeypatch):
    """no array is joined to text in the step that has a row per drop."""
    monkeypatch.setattr(scale, "LIST_BYTES", 1 << 4)
    sf = "/root/testdata/sf0.001"
    for query in (entries.match_rivers, entries.follow_rivers, entries.feed_routes):
        plan = query(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert "array_join" not in plan, query.__name__


def test_null_parts_and_repeated_lists_stay(spark, monkeypatch):
    lists = spark.createDataFrame([("u", None, "1", "2"), ("u", 0, "3", "4"), ("u", 0, "3", "4")], LISTS)
    rows = spark.createDataFrame([(1, "u"), (1, "u"), (2, "v"), (None, "u")], "id bigint, key string")
    want = Counter((i, p, r) for i in (1, 1, None) for p, r in ((None, "1"), (0, "3"), (0, "3")))
    for small in (True, False):
        got = tweets.routed(rows, lists, small=small).collect()
        assert Counter((r.id, r.part, r.river_id) for r in got) == want
    drops = spark.createDataFrame([("u", "d"), (None, "d"), ("u", "d")], "identity_orig_id string, droplet_orig_id string")
    parts = spark.createDataFrame([("u", 0, "1", "2"), ("u", 1, "1", "3")], "url string, part bigint, river_ids string, channel_ids string")
    monkeypatch.setattr(scale, "is_small", lambda *a, **k: False)
    stamps = [feeds.stamp(drops, parts, dealt=dealt).collect() for dealt in (False, True)]
    assert Counter(tuple(sorted(r.asDict().items())) for r in stamps[0]) == Counter(tuple(sorted(r.asDict().items())) for r in stamps[1])
    assert len(stamps[1]) == 4
