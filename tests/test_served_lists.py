"""Drops that share long lists of subscribers are served together, each list stored once."""

from pathlib import Path

from pyspark.sql import functions as F

from tributary.operators import feeds, scale

CHANNELS = {"u": "u" * 40_000, "v": "v" * 40_000, "w": "w" * 40_000}


def test_a_list_is_written_once_and_not_once_per_drop(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(scale, "LIST_BYTES", 1 << 10)
    monkeypatch.setattr(scale, "LIST_ROWS", 100)
    # Lists of a URL in 12 parts: more than a file's dictionary holds, if drops mix them.
    lists = [(u, part, f"{part}", f"{part}{c}") for u, c in CHANNELS.items() for part in range(12)]
    subs = spark.createDataFrame(lists, "url string, part bigint, river_ids string, channel_ids string")
    cache = spark.range(450).select(
        "id", F.element_at(F.array(*map(F.lit, "uvw")), (F.col("id") % 3 + 1).cast("int")).alias("url"),
        F.struct(F.col("id").cast("string").alias("droplet_title")).alias("drop"),
    )
    # Ids may repeat, and a drop without URL is nobody's.
    cache = cache.unionByName(cache.where("id < 3")).unionByName(
        cache.where("id < 3").withColumn("url", F.lit(None).cast("string"))
    ).coalesce(1)
    jobs = spark.createDataFrame([("u", True), ("v", True), ("w", False)], "url string, use_cache boolean")
    served, _ = feeds.serve_from_cache(jobs, cache, subs)
    served.write.parquet(f"{tmp_path}/served")

    got = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/served").select(
        "id", "part", "droplet_title", "river_id", F.substring("channel_ids", -1, 1), F.length("channel_ids")
    ).collect())
    ids = [i for i in [*range(450), 0, 1, 2] if i % 3 < 2]
    assert got == sorted(
        (i, p, str(i), str(p), "uv"[i % 3], 40_000 + len(str(p))) for i in ids for p in range(12)
    )
    order = spark.read.parquet(f"{tmp_path}/served").select(
        F.input_file_name().alias("f"), F.concat("part", F.substring("channel_ids", -1, 1)).alias("l")
    )
    for listed in order.groupBy("f").agg(F.collect_list("l").alias("l")).collect():
        changes = sum(a != b for a, b in zip(listed.l, listed.l[1:]))
        # Each of 24 lists once for each of the at most 3 groups of its drops.
        assert changes < 24 * 3
    assert sum(f.stat().st_size for f in Path(f"{tmp_path}/served").glob("*.parquet")) < 6_000_000
