"""The cache in buckets of URLs: what is opened and written; live registry changes."""

import os

from pyspark.sql import functions as F

from tributary.operators import registry
from tributary.plans import rss
from tributary.sources import deltas
from tributary.streaming import jobs, state

CACHE = "id bigint, url string, date_pub bigint, drop struct<droplet_title:string,droplet_raw:string>"


def cache(spark, n=200):
    return spark.range(n).select(
        "id", F.concat(F.lit("u"), (F.col("id") % 40).cast("string")).alias("url"), F.col("id").alias("date_pub"),
        F.struct(F.col("id").cast("string").alias("droplet_title"), F.lit("x" * 200).alias("droplet_raw")).alias("drop"),
    )


def test_only_buckets_of_the_urls_asked_for_are_opened(spark, tmp_path):
    path = str(tmp_path / "cache")
    rss.start_cache(cache(spark), path, 16)
    asked = spark.createDataFrame([("u1", True), ("u2", True), ("u3", False), ("none", True)], "url string, use_cache boolean")
    parts = spark.createDataFrame([("u1", 0, [7], [8]), ("u3", 0, [7], [8])], "url string, part bigint, river_ids array<bigint>, channel_ids array<bigint>")
    served, left = rss.serve(asked, path, parts)
    assert sorted(r.id for r in served.collect()) == [1, 41, 81, 121, 161]
    assert sorted(r.url for r in left.collect()) == ["none", "u3"]
    buckets = deltas.touched_buckets(spark, path, asked.where("use_cache"))
    opened = {f.split("bucket=")[1].split("/")[0] for f in served.inputFiles() if "bucket=" in f}
    assert opened <= {str(b) for b in buckets} and len(buckets) < 16


def test_inserts_write_new_and_displaced_rows_only(spark, tmp_path):
    path = str(tmp_path / "cache")
    rss.start_cache(cache(spark), path, 16)
    new = cache(spark, 1).withColumns({"id": F.lit(1000).cast("bigint"), "url": F.lit("u5"), "date_pub": F.lit(999).cast("bigint")})
    rss.insert(new, path, jobs.Batch(0), keep=3)
    changed = deltas.feed(spark, path).select("id", "deleted").collect()
    assert sorted(map(tuple, changed)) == [(5, True), (45, True), (1000, False)]
    rows = deltas.read(spark, path).where("url = 'u5'").select("id").collect()
    assert sorted(r.id for r in rows) == [85, 125, 165, 1000]
    before = {d for d, _, _ in os.walk(f"{path}/base")}
    deltas.fold(spark, path)
    assert len([d for d, _, _ in os.walk(f"{path}/base") if d not in before and "bucket=" in d]) == 1
    # Fetched again, a drop replaces its row.
    rss.insert(new, path, jobs.Batch(1), keep=9)
    assert deltas.read(spark, path).where("id = 1000").count() == 1


PREDICATES = "type string, term string, channel_id bigint, river_id bigint"
CHANGES = f"{PREDICATES}, op string, seq struct<seq:bigint,at:int>"


def test_what_changes_nothing_is_not_published(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    current = spark.createDataFrame([("track", "a", 1, 1), ("track", "b", 1, 1)], PREDICATES)
    deltas.start(current, table, ["term", "type", "channel_id"], 4)

    def go(*rows):
        frame = spark.createDataFrame([(*r[:-1], (r[-1], 0)) for r in rows], CHANGES)
        frame.coalesce(1).write.mode("append").parquet(source)
        jobs.finish(jobs.keep_predicates(spark.readStream.schema(CHANGES).parquet(source), table, check))
        feed = deltas.feed(spark, table, "change string").select("batch", "term", "change").collect()
        return sorted(map(tuple, feed))

    first = go(("track", "a", 1, 2, "add", 1), ("track", "b", 1, 1, "delete", 2), ("track", "c", 1, 1, "add", 3))
    assert first == [(0, "a", "moved"), (0, "b", "removed"), (0, "c", "added")]
    assert go(("track", "a", 1, 2, "add", 4), ("track", "b", 1, 1, "delete", 5)) == first
    assert go(("track", "c", 1, 1, "delete", 6), ("track", "c", 1, 1, "add", 7)) == first
    assert not os.path.exists(f"{table}/changes/epoch=0/run={jobs._run_id(spark, check)}/batch=2")
    held = deltas.read(spark, table).select("term", "river_id").collect()
    assert sorted(map(tuple, held)) == [("a", 2), ("c", 1)]


def test_names_wait_for_their_ids(spark, tmp_path):
    names, ids, table, check = (str(tmp_path / n) for n in ("names", "ids", "table", "check"))
    deltas.start(spark.createDataFrame([], PREDICATES), table, ["term", "type", "channel_id"], 4)

    def go(events, captured):
        rows = [("follow", n, c, 1, op, (seq, 0)) for n, c, op, seq in events]
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(names)
        schema = "screen_name string, user_id string"
        spark.createDataFrame(captured, schema).coalesce(1).write.mode("append").parquet(ids)
        changes = state.follows_by_id(
            spark.readStream.schema(CHANGES).parquet(names), spark.readStream.schema(schema).parquet(ids)
        )
        jobs.finish(jobs.keep_predicates(changes, table, check))
        return sorted(tuple(r) for r in deltas.read(spark, table).select("term", "channel_id").collect())

    assert go([("ann", 1, "add", 1), ("bob", 2, "add", 2), ("bob", 3, "add", 3)], [("ann", "11"), ("ann", "12")]) == [("11", 1)]
    # Bob's id comes after one of his channels was taken out again; Ann keeps her first.
    assert go([("bob", 3, "delete", 4)], [("bob", "20"), ("ann", "10")]) == [("11", 1), ("20", 2)]
    assert go([("ann", 4, "add", 5)], []) == [("11", 1), ("11", 4), ("20", 2)]


def test_entry_changes_of_repeated_events(spark):
    before = spark.createDataFrame([("track", "a", 1, 1)], PREDICATES)
    rows = [("track", "a", 1, 1, "delete", (1, 0)), ("track", "a", 1, 3, "add", (1, 1)), ("track", "z", 1, 1, "delete", (2, 0))]
    changed = registry.entry_changes(before, spark.createDataFrame(rows, CHANGES), ["type", "term", "channel_id"])
    assert [(r.term, r.river_id, r.change, r.deleted) for r in changed.collect()] == [("a", 3, "moved", False)]
