"""Keyed state and its timers, over runs of one checkpoint."""

from pyspark.sql import functions as F

from tributary.operators import schedule
from tributary.sources import deltas
from tributary.streaming import jobs, state

EVENTS = "url string, channel_id bigint, river_id bigint, op string, seq struct<seq:bigint,at:int>"
START = 1_700_000_000


def feed(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).parquet(folder)


def test_subscriptions_over_restarts(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    current = spark.createDataFrame([("u", 7, 1), ("v", 8, 2)], "url string, river_id bigint, channel_id bigint")
    deltas.start(current, table, ["url", "channel_id"], 4)

    def go(*rows):
        stream = feed(spark, source, [(u, c, r, op, (seq, 0)) for u, c, r, op, seq in rows], EVENTS)
        out = jobs.run(
            state.subscriptions(stream, current), lambda df, n: deltas.append(df, table, n), check
        )
        jobs.finish(out)
        return sorted(tuple(r) for r in deltas.read(spark, table).select("url", "channel_id", "river_id").collect())

    assert go(("u", 1, 7, "delete", 10), ("w", 3, 9, "add", 11)) == [("v", 2, 8), ("w", 3, 9)]
    # An older event comes late and changes nothing; a younger one moves the channel.
    assert go(("u", 1, 7, "add", 5), ("w", 3, 4, "add", 12)) == [("v", 2, 8), ("w", 3, 4)]
    assert go(("u", 1, 6, "add", 13), ("v", 2, 8, "add", 14)) == [("u", 1, 6), ("v", 2, 8), ("w", 3, 4)]
    # Nothing is rewritten: what changed nothing wrote no row.
    last = spark.read.parquet(f"{table}/changes").groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in last] == [2, 1, 1]


RESPONSES = (
    "url string, seq bigint, status int, last_fetch_etag string, last_fetch_modified string, last_fetch_time bigint"
)


def test_a_url_waits_for_its_response(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    stored = spark.createDataFrame(
        [(1, "http://a/?x&amp;y", START, "e", None, "h"), (2, "http://b", START, None, None, "h")],
        "id bigint, url string, last_fetch_time bigint, last_fetch_etag string,"
        " last_fetch_modified string, url_hash string",
    )
    current = schedule.load_state(stored)

    def go(*rows):
        stream = feed(spark, source, rows, RESPONSES)
        jobs.finish(jobs.schedule_fetches(stream, current, out, check))
        made = spark.read.parquet(out).select("fetch_url", "mode", "last_fetch_time").collect()
        return sorted(tuple(r) for r in made)

    # The clock is a response of another URL.
    assert go(("http://clock", 1, 200, None, None, START + 100)) == []
    first = go(("http://clock", 2, 200, None, None, START + 3 * 3600))
    assert first == [("http://a/?x&y", "etag", START), ("http://b", "full", START)]
    # However late it gets, the job is not repeated without a response.
    assert [r for r in go(("http://clock", 3, 200, None, None, START + 9 * 3600)) if "clock" not in r[0]] == first
    late = START + 9 * 3600 + 1
    go(("http://b", 4, 200, None, "d", late))
    again = go(("http://clock", 5, 200, None, None, late + 2 * 3600))
    assert ("http://b", "modified", late) in again and len([r for r in again if r[0] == "http://a/?x&y"]) == 1


MESSAGES = "message_id bigint, attempt bigint, status int, at timestamp"


def test_deliveries_end(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def go(*rows):
        rows = [(*r[:3], r[3] + START) for r in rows]
        frame = spark.createDataFrame(rows, "message_id bigint, attempt bigint, status int, s bigint")
        timed = frame.select("message_id", "attempt", "status", F.timestamp_seconds("s").alias("at"))
        timed.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        jobs.finish(jobs.deliver(stream, out, check, wait=30, most=1))
        made = spark.read.parquet(out).select("message_id", "kind", "attempt").collect()
        return sorted(tuple(r) for r in made)

    sent = [(1, "sent", 1), (2, "sent", 1), (3, "sent", 1)]
    assert go((1, 0, None, 0), (2, 0, None, 0), (3, 0, None, 0)) == sent
    # 1 is delivered, 2 fails; 3 gets no answer and goes out again; 9 was never sent.
    second = go((1, 1, 200, 10), (2, 1, 503, 10), (9, 1, 200, 50))
    assert second == sorted([*sent, (1, "delivered", 1), (2, "sent", 2), (3, "sent", 1)])
    third = go((2, 2, 503, 60), (3, 1, 200, 60), (1, 2, 200, 60), (9, 1, 200, 200))
    assert (2, "given up", 2) in third and (3, "delivered", 1) in third
    assert len([r for r in third if r[0] in (1, 9)]) == 2
