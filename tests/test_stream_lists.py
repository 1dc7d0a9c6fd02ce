"""Streams store the lists that drops share once per batch; pairs are not made distinct one by one."""

from collections import Counter

from pyspark.sql import functions as F

from tributary.operators import scale, tweets
from tributary.streaming import jobs

REGISTRY = "type string, term string, channel_id bigint, river_id bigint"


def _known(spark, first=0):
    """The term cat has 40 channels, the term big 30, ten of them the same."""
    rows = [("track", t, first + c, c % 3) for t, r in (("cat", range(40)), ("big", range(30, 60))) for c in r]
    return spark.createDataFrame(rows, REGISTRY)


def test_matched_ids_and_lists_are_stored_apart(spark, tmp_path):
    texts = F.when(F.col("id") % 3 == 0, "a big cat").when(F.col("id") % 3 == 1, "cat")
    drops = spark.range(300).select("id", texts.alias("droplet_raw"))
    for run in (0, 1):
        drops.where(F.col("id") % 2 == run).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(drops.schema).parquet(f"{tmp_path}/in")
        # The registry changes between the runs: each drop keeps the lists of its own batch.
        known = _known(spark, 100 * run)
        jobs.finish(jobs.match_drops(stream, lambda _, k=known: k, "track", f"{tmp_path}/out", f"{tmp_path}/c"))
    sets, lists = jobs.keyed(spark, f"{tmp_path}/out")
    assert sets.count() == 200 and "channel_ids" not in sets.columns
    assert lists.count() == lists.select("key").distinct().count() == 4
    got = {r["id"]: (r["part"], r["river_id"], r["channel_ids"]) for r in jobs.rivers_of(spark, f"{tmp_path}/out").collect()}
    assert got == {
        k: (0, [0, 1, 2], [100 * (k % 2) + c for c in range(40 if k % 3 else 60)]) for k in range(300) if k % 3 < 2
    }


def test_channels_of_drops_come_once(spark, monkeypatch):
    known = _known(spark)
    # One id has two texts, as one status may come in two batches; parts of terms differ.
    plain = spark.createDataFrame(
        [("a", "x cat"), ("a", "y big"), ("b", "x cat"), ("b", "x cat"), ("c", "y big"), (None, "y big"), ("d", "z none")],
        "id string, key string",
    )
    cat = tweets.term_subscribers(known, "track", 10).where("term = 'cat'")
    big = tweets.term_subscribers(known, "track", 7).where("term = 'big'")
    lists = cat.withColumn("term", F.lit("x cat")).unionByName(big.withColumn("term", F.lit("y big")))
    lists = lists.select(F.col("term").alias("key"), "part", F.col("rivers").alias("river_id"), F.col("channels").alias("channel_ids"))
    overlap = lists.where("key = 'x cat'").limit(1).withColumn("part", F.lit(99).cast("bigint"))
    want = Counter(
        [("a", c) for c in range(60)] + [("b", c) for c in range(40)] + [(None, c) for c in range(30, 60)]
        + [("c", c) for c in range(30, 60)]
    )
    for small in (True, False):
        monkeypatch.setattr(scale, "is_small", lambda *a, small=small, **k: small)
        out = tweets.channels_of(plain, lists.unionByName(overlap))
        assert out.columns == ["id", "channel_id"]
        assert Counter((r.id, r.channel_id) for r in out.collect()) == want
        # No pair is shuffled for being made distinct.
        assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString().partition("Generate")[0]
