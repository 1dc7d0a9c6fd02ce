"""Delta tables: last change wins, bytes follow the batch, folds touch what changed."""

import os

import pytest
from pyspark.sql import functions as F

from tributary.operators import push
from tributary.sources import deltas, readers
from tributary.streaming import jobs

SCHEMA = "k bigint, s string, v bigint"


def batch(number, run="r"):
    made = jobs.Batch(number)
    made.run = run
    return made


def files(path):
    return {
        os.path.join(d, f): os.path.getsize(os.path.join(d, f))
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit("a").alias("s"), F.col("id").alias("v"))
    deltas.start(rows, path, ["k", "s"], buckets=8)
    return path


def change(spark, *rows):
    return spark.createDataFrame(rows, f"{SCHEMA}, deleted boolean")


def value(spark, path, k, **how):
    row = deltas.read(spark, path, **how).where(F.col("k") == k).first()
    return row and row.v


def test_last_change_wins_and_deleted_rows_are_gone(spark, table):
    assert deltas.read(spark, table).count() == 2000
    deltas.append(change(spark, (1, "a", 10, False), (2, "a", 0, True), (9000, "b", 5, False)), table, batch(0))
    deltas.append(change(spark, (1, "a", 11, False), (9000, "b", None, True)), table, batch(1))
    assert [value(spark, table, k) for k in (1, 2, 3, 9000)] == [11, None, 3, None]
    assert value(spark, table, 1, upto=(0, 0)) == 10 and value(spark, table, 9000, before=(0, 1)) == 5
    # The same batch again replaces its own rows.
    deltas.append(change(spark, (1, "a", 12, False)), table, batch(1))
    assert value(spark, table, 1) == 12 and value(spark, table, 9000) == 5


def test_a_new_checkpoint_goes_on_behind_the_old_one(spark, table):
    deltas.append(change(spark, (1, "a", 10, False), (2, "a", 20, False)), table, batch(7, "old"))
    deltas.append(change(spark, (1, "a", 11, False)), table, batch(0, "new"))
    assert deltas.position(spark, table, batch(7, "old")) == (0, 7)
    assert deltas.position(spark, table, batch(3, "new")) == (1, 3)
    assert [value(spark, table, k) for k in (1, 2)] == [11, 20]


def test_bytes_follow_the_batch_and_folds_leave_other_buckets(spark, table):
    before = files(table)
    deltas.append(change(spark, (1, "a", 10, False)), table, batch(0))
    written = {f: n for f, n in files(table).items() if f not in before}
    assert sum(written.values()) < 3000 < sum(before.values())
    touched = deltas.touched_buckets(spark, table, change(spark, (1, "a", 10, False)))
    deltas.fold(spark, table)
    new = {f for f in files(table) if f not in before and "/base/" in f}
    assert new and all(f"fold=1/bucket={touched[0]}/" in f for f in new)
    assert value(spark, table, 1) == 10 and deltas.read(spark, table).count() == 2000
    old = deltas.expired(spark, table)
    assert len(old) == 2 and any("changes" in p for p in old) and any("fold=0" in p for p in old)
    deltas.append(change(spark, (1, "a", 0, True)), table, batch(1))
    assert value(spark, table, 1) is None


def test_reads_of_known_keys_open_their_buckets_only(spark, table):
    key = spark.createDataFrame([(5,)], "k bigint")
    buckets = deltas.touched_buckets(spark, table, key)
    rows = deltas.read(spark, table, buckets)
    assert {f.split("bucket=")[1].split("/")[0] for f in rows.inputFiles()} == {str(buckets[0])}
    assert rows.where("k = 5").count() == 1


def test_an_emptied_bucket_stays_empty(spark, tmp_path):
    path = str(tmp_path / "small")
    deltas.start(spark.createDataFrame([(1, "a", 1)], SCHEMA), path, ["k"], 4)
    deltas.append(change(spark, (1, "a", 1, True)), path, batch(0))
    deltas.fold(spark, path)
    assert deltas.read(spark, path).isEmpty()


def test_what_a_broken_batch_wrote_is_not_read(spark, tmp_path):
    """The log has its changes, the settings have not: readers keep to the common batch."""
    log, settings, marks, source = (str(tmp_path / n) for n in ("log", "settings", "marks", "in"))
    schema = "bucket_id bigint, droplet_id bigint, droplet_push_status int, droplet_date_push string"
    deltas.start(spark.createDataFrame([(1, d, 0, None) for d in range(9)], schema), log, ["bucket_id", "droplet_id"], 4)
    deltas.start(spark.createDataFrame([(1, 5)], "bucket_id bigint, pending_drop_count bigint"), settings, ["bucket_id"], 4)
    pairs = "bucket_id bigint, droplet_id bigint"
    spark.createDataFrame([(1, 1), (1, 2), (2, 2)], pairs).write.parquet(source)

    def go():
        stream = spark.readStream.schema(pairs).parquet(source)
        jobs.finish(jobs.log_push_changes(stream, log, settings, marks, 0, str(tmp_path / "check")))

    go()
    at = deltas.common(spark, marks)
    assert at == [(0, 0), (0, 0)]
    run = jobs._run_id(spark, str(tmp_path / "check"))
    half = spark.createDataFrame([(1, 3, 1, "x", False)], f"{schema}, deleted boolean")
    deltas.append(half, log, batch(1, run))
    assert push.pending_by_log(deltas.read(spark, log, upto=at[0])).first().pending == 7
    assert deltas.read(spark, settings, upto=at[1]).first().pending_drop_count == 3
    spark.createDataFrame([(1, 4)], pairs).write.mode("append").parquet(source)
    go()
    at = deltas.common(spark, marks)
    pushed = deltas.read(spark, log, upto=at[0]).where("droplet_push_status = 1")
    assert sorted(r.droplet_id for r in pushed.collect()) == [1, 2, 4]
    assert deltas.read(spark, settings, upto=at[1]).first().pending_drop_count == 2


def test_versions_expire(spark, tmp_path):
    path = str(tmp_path / "versioned")
    for version in (-1, 0, 1, 2):
        jobs.sinks.publish_version(spark.range(version + 2), path, version)
    assert jobs.latest_common_version(spark, path) == 2
    assert [p.rpartition("=")[2] for p in readers.expired_versions(spark, path)] == ["-1", "0"]
    with pytest.raises(FileNotFoundError):
        readers.latest_version(spark, path, before=-1)


def test_a_new_checkpoint_keeps_old_rows(spark, tmp_path):
    """Batch 0 of a query that starts anew is not batch 0 of its predecessor."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for check in ("a", "b"):
        spark.range(3).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id bigint").parquet(source)
        jobs.finish(jobs.run(stream, lambda df, n: jobs.sinks.append_batch(df, out, n), str(tmp_path / check)))
    assert spark.read.parquet(out).count() == 3 + 6
