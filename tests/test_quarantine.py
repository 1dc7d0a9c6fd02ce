"""Broken input is kept apart and not counted as read."""

import json

from pyspark.sql import functions as F

from tributary import schemas
from tributary.operators import feeds, mail
from tributary.plans import rss
from tributary.sources import readers
from tributary.streaming import jobs

NOW = 1_704_067_200
RSS = '<?xml version="1.0"?><rss version="2.0"><channel><title>T</title><item><guid>{}</guid></item></channel></rss>'
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><entry><id>{}</id></entry></feed>'
DOCS = (
    "url string, fetch_id bigint, doc string, status int, etag string, modified string, fetched_at bigint"
)
STATE = (
    "url string, last_fetch_time bigint, last_fetch_etag string, "
    "last_fetch_modified string, next_fetch_time bigint, submitted boolean"
)


def captured(spark, **docs):
    rows = [(u, k, d, 200 if d else 304, "e", None, NOW) for k, (u, d) in enumerate(docs.items())]
    return spark.createDataFrame(rows, DOCS)


def test_a_byte_order_mark_is_no_fault(spark):
    docs = captured(spark, a="﻿" + RSS.format(1), b="﻿" + ATOM.format(2), c="﻿plain")
    assert sorted(r.entry_id for r in feeds.entries(docs).collect()) == ["1", "2"]
    assert [r.url for r in feeds.quarantined(docs).collect()] == ["c"]


def test_a_broken_feed_is_due_again(spark):
    docs = captured(spark, a=RSS.format(1), b=RSS.format(2)[:-9], c="<html></html>", d=None)
    state = spark.createDataFrame([(u, 5, None, None, 6, False) for u in "abcd"], STATE)
    options = [(k, 1, json.dumps({"value": u})) for k, u in enumerate("abcd")]
    active = spark.createDataFrame(options, "channel_id bigint, river_id bigint, parameters string")
    empty = spark.createDataFrame([], "id bigint, url string, date_pub bigint, drop struct<droplet_title:string>")
    drops, responses, after, _ = rss.refresh(state, active, docs, empty, NOW)
    assert sorted(r.url for r in responses.collect()) == ["a", "d"]
    assert [r.identity_orig_id for r in drops.collect()] == ["a"]
    rows = {r.url: r for r in after.collect()}
    assert [rows[u].last_fetch_time for u in "abcd"] == [NOW, 5, 5, NOW]
    assert not any(r.submitted for r in rows.values()) and rows["b"].next_fetch_time == 6


def test_bodies_that_are_cut_off_or_no_object(spark, tmp_path):
    whole = json.dumps(dict(id="1", river_id="2", channel="rss", parameters="{}"))
    bodies = [whole, whole[:-1], whole[:20], "", "[1]", "7", None, "{}"]
    rows = [("k", None, None, k, b) for k, b in enumerate(bodies)]
    schema = "routing_key string, correlation_id string, reply_to string, seq bigint, body string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    read = readers.messages(spark, str(tmp_path / "in"), schemas.CHANNEL_EVENT)
    assert {r.seq for r in readers.broken(read).collect()} >= {1, 2, 3, 5, 6}
    assert 0 in {r.seq for r in read.where("m.id = '1'").collect()}
    assert read.where("m.id = '1'").count() == 1


def test_mail_is_parsed_once_a_batch(spark, tmp_path, monkeypatch):
    """What the sinks read is a stored table: the plan of each has no parser in it."""
    plans, append, parse = [], jobs.sinks.append_batch, mail.parse
    text = b"From: a@b\r\nTo: r@in\r\nSubject: s\r\n\r\nbody"
    schema = "mail_id bigint, mailfrom string, rcptto array<string>, data binary"
    spark.createDataFrame([(1, "a@b", ["river1@in.example"], text)], schema).write.parquet(str(tmp_path / "in"))

    def keep(rows, path, batch_id):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        append(rows, path, batch_id)

    monkeypatch.setattr(jobs.sinks, "append_batch", keep)
    rivers = spark.createDataFrame([(1, "river1", "river1@in.example", 1)], "id bigint, name string, address string, river_active int")
    calls = []
    monkeypatch.setattr(mail, "parse", lambda m: calls.append(1) or parse(m))
    monkeypatch.setattr(mail, "with_rivers", lambda m, r: m.withColumn("river_id", F.array(F.lit(1).cast("bigint"))))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    jobs.finish(jobs.receive_mail(stream, lambda s: rivers, str(tmp_path / "out"), str(tmp_path / "check")))
    assert len(calls) == 1 and plans and not any("Pandas" in p or "Arrow" in p for p in plans)


def test_lists_of_subscribers_are_neither_dealt_nor_sorted(spark, tmp_path, monkeypatch):
    """drops are dealt and sorted by channel and day before they get their lists."""
    plans, replace = [], jobs.sinks._replace_partitions

    def keep(rows, *arguments):
        if "channel_ids" in rows.columns:
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        replace(rows, *arguments)

    monkeypatch.setattr(jobs.sinks, "_replace_partitions", keep)
    docs = captured(spark, a=RSS.format(1), b=RSS.format(2), c=ATOM.format(3), d=ATOM.format(4))
    docs.write.parquet(str(tmp_path / "in"))
    asked = spark.createDataFrame([(u, 0, None, None) for u in "abc"], STATE.split(", next")[0])
    lists = [("a", 0, [1], [5, 6]), ("a", 1, [1, 2], [7]), ("b", 0, [3], [8])]
    subscribed = spark.createDataFrame(lists, "url string, part bigint, river_ids array<bigint>, channel_ids array<bigint>")
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    jobs.finish(jobs.fetch_feeds(stream, lambda s: asked, lambda s: subscribed, NOW, out, str(tmp_path / "check")))
    rows = spark.read.parquet(f"{out}/drops").collect()
    assert sorted((r.identity_orig_id, r.part, r.river_id, r.channel_ids) for r in rows) == lists
    assert {(r.channel, str(r.day)) for r in rows} == {("rss", "2024-01-01")} and "_place" not in rows[0]
    (plan,) = plans
    assert plan.index("Join") < plan.index("Sort") < plan.index("RebalancePartitions")
