import json

from pyspark.sql import functions as F

from tributary.operators import push, registry, schedule
from tributary.plans import enrichment, rss
from tributary.sources import readers, sinks
from tributary.streaming import jobs

MESSAGES = "routing_key string, body string, seq bigint"


def message(op, seq, channel_id, terms):
    body = dict(id=channel_id, river_id=1, channel="twitter",
                parameters=json.dumps({"value": {"k": terms}}))
    return (f"web.channel.twitter.{op}", json.dumps(body), seq)


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).parquet(f"{folder}/*")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_registry_folds_over_two_runs_as_in_batch(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    empty = spark.createDataFrame(
        [], "type string, term string, channel_id bigint, river_id bigint"
    )
    jobs.start_table(empty, table)
    first = [message("add", 1, 1, "a,b"), message("add", 2, 2, "c")]
    second = [message("delete", 3, 1, "a"), message("add", 4, 3, "a")]
    for name, batch in (("1", first), ("2", second)):
        write(spark, source, name, batch, MESSAGES)
        jobs.finish(
            jobs.fold_registry(stream(spark, source, MESSAGES), table, check)
        )
    got = rows(readers.latest_version(spark, table).select("term", "channel_id"))
    assert got == [("a", 3), ("b", 1), ("c", 2)]


def test_a_repeated_batch_leaves_one_copy(spark, tmp_path):
    out = str(tmp_path / "out")
    drops = spark.range(3).select(
        F.lit("rss").alias("channel"), F.col("id").cast("string").alias("droplet_orig_id"),
        F.timestamp_seconds("id").alias("droplet_date_pub"),
    )
    for _ in range(2):
        sinks.append_drops(drops, out, 0)
    assert spark.read.parquet(out).count() == 3


def test_pushes_are_logged_once_in_both_tables(spark, tmp_path):
    source, log, settings, check = (
        str(tmp_path / n) for n in ("in", "log", "settings", "check")
    )
    jobs.start_table(
        spark.createDataFrame(
            [(1, 1, 0, None), (1, 2, 0, None)],
            "bucket_id bigint, droplet_id bigint, droplet_push_status int, "
            "droplet_date_push string",
        ),
        log,
    )
    jobs.start_table(
        spark.createDataFrame([(1, 2)], "bucket_id bigint, pending_drop_count bigint"),
        settings,
    )
    schema = "bucket_id bigint, droplet_id bigint"
    write(spark, source, "1", [(1, 1)], schema)
    jobs.finish(
        jobs.log_pushes(stream(spark, source, schema), log, settings, 0, check)
    )
    pending = readers.latest_version(spark, settings).first()["pending_drop_count"]
    by_log = push.pending_by_log(readers.latest_version(spark, log)).first()["pending"]
    assert pending == by_log == 1
    assert jobs.latest_common_version(spark, log, settings) == 0


def test_new_subscribers_get_a_job_from_the_cache(spark, tmp_path):
    source, table, out, check = (
        str(tmp_path / n) for n in ("in", "table", "jobs", "check")
    )
    body = json.dumps(dict(id=1, river_id=2, channel="rss",
                           parameters=json.dumps({"value": "u"})))
    write(spark, source, "1", [("web.channel.rss.add", body, 1)], MESSAGES)
    jobs.start_table(
        spark.createDataFrame([], "url string, river_id bigint, channel_id bigint"), table
    )
    state = spark.createDataFrame(
        [("u", 5, "e", None, 6, False)],
        "url string, last_fetch_time bigint, last_fetch_etag string, "
        "last_fetch_modified string, next_fetch_time bigint, submitted boolean",
    )
    jobs.finish(
        jobs.fold_subscriptions(
            stream(spark, source, MESSAGES), table, lambda _: state, out, check
        )
    )
    assert rows(readers.latest_version(spark, table)) == [("u", 2, 1)]
    job = spark.read.parquet(out).first()
    assert job["use_cache"] and job["last_fetch_etag"] == "e"


def test_fetch_state_follows_responses(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    stored = spark.createDataFrame(
        [(1, "u", None, None, None, "h")],
        "id bigint, url string, last_fetch_time bigint, last_fetch_etag string, "
        "last_fetch_modified string, url_hash string",
    )
    jobs.start_table(schedule.load_state(stored), table)
    schema = (
        "url string, seq bigint, status int, last_fetch_etag string, "
        "last_fetch_modified string, last_fetch_time bigint"
    )
    for seq in (1, 2):
        write(spark, source, str(seq), [("u", seq, 200, None, None, 10 * seq)], schema)
        jobs.finish(
            jobs.apply_fetch_responses(stream(spark, source, schema), table, check)
        )
    assert readers.latest_version(spark, table).first()["last_fetch_time"] == 20


def test_readers_and_short_domains(spark, tmp_path):
    path = str(tmp_path / "domains.txt")
    (tmp_path / "domains.txt").write_text("bit.ly \n\n➡.ws\ntk.\n")
    got = readers.short_domains(spark, path)
    assert rows(got) == [("bit.ly",), ("tk.",), ("➡.ws",)]
    body = json.dumps({"url": "u", "status": 200})
    spark.createDataFrame(
        [("k", "c", "r", 1, body), ("k", "c", "r", 2, "broken")],
        "routing_key string, correlation_id string, reply_to string, "
        "seq bigint, body string",
    ).write.parquet(str(tmp_path / "messages"))
    parsed = readers.fetch_responses(spark, str(tmp_path / "messages")).orderBy("seq")
    assert [r["url"] for r in parsed.select("m.url").collect()] == ["u", None]
    assert [r["seq"] for r in readers.broken(parsed).collect()] == [2]


def test_subscriptions_table_shape(spark):
    active = spark.createDataFrame(
        [(1, 2, '{"value":"u"}'), (2, 2, "broken")],
        "channel_id bigint, river_id bigint, parameters string",
    )
    assert rows(registry.subscriptions(active)) == [("u", 2, 1)]


def test_feeds_mail_pushes_and_enrichment_as_streams(spark, tmp_path):
    out = lambda name: str(tmp_path / name)
    doc = (
        "<rss><channel><item><guid>g</guid><description>see http://x/1</description>"
        "</item></channel></rss>"
    )
    feed_schema = (
        "url string, fetch_id bigint, doc string, status int, etag string, "
        "modified string, fetched_at bigint"
    )
    write(spark, out("feeds"), "1", [("u", 1, doc, 200, "e", None, 9)], feed_schema)
    job = spark.createDataFrame(
        [("u", 0, None, None)],
        "url string, last_fetch_time bigint, last_fetch_etag string, "
        "last_fetch_modified string",
    )
    subs = spark.createDataFrame(
        [("u", 0, [1], [2])],
        "url string, part bigint, river_ids array<bigint>, channel_ids array<bigint>",
    )
    jobs.finish(
        jobs.fetch_feeds(
            stream(spark, out("feeds"), feed_schema), lambda _: job, lambda _: subs,
            1704067200, out("fed"), out("c1"),
        )
    )
    drop = spark.read.parquet(out("fed/drops")).first()
    assert drop["river_id"] == [1] and str(drop["day"]) == "2024-01-01"
    assert spark.read.parquet(out("fed/responses")).first()["last_fetch_etag"] == "e"

    mail_schema = "mail_id bigint, mailfrom string, rcptto array<string>, data string"
    raw = "Subject: s\nDate: Mon, 01 Jan 2024 00:00:00 +0000\n\nhi"
    write(spark, out("mail"), "1", [(1, "a@b", ["r@h"], raw)], mail_schema)
    river = spark.createDataFrame(
        [(4, 1, "r")], "id bigint, river_active int, email_id string"
    )
    jobs.finish(
        jobs.receive_mail(
            stream(spark, out("mail"), mail_schema), lambda _: river, out("mailed"), out("c2")
        )
    )
    assert spark.read.parquet(out("mailed/drops")).first()["river_id"] == [4]
    assert spark.read.parquet(out("mailed/quarantine")).isEmpty()

    drop_schema = (
        "id bigint, droplet_raw string, droplet_content string, "
        "correlation_id string, reply_to string"
    )
    write(spark, out("drops"), "1", [(1, "http://x/1", "x", "c", "q")], drop_schema)
    attempt = spark.createDataFrame(
        [("c", 1, 200, '{"k":["v"]}')],
        "correlation_id string, attempt int, status int, body string",
    )
    probes = spark.createDataFrame([], "url string, width int, height int")
    expanded = spark.createDataFrame([], "url string, full_url string")
    enrichers = {
        "tags": lambda b: enrichment.tags_and_places(b, attempt),
        "links": lambda b: enrichment.links_and_images(b, expanded, probes),
    }
    for name, enricher in enrichers.items():
        source = stream(spark, out("drops"), drop_schema)
        jobs.finish(jobs.enrich(source, enricher, out(name), out("c-" + name)))
    assert spark.read.parquet(out("tags")).first()["tags"][0]["tag_name"] == "v"
    linked = spark.read.parquet(out("links")).first()
    assert linked["links"][0]["url"] == "http://x/1" and linked["reply_to"] == "q"

    push_schema = (
        "bucket_id bigint, post_url string, client_id string, client_secret string, "
        "routing_key string, drop struct<id:bigint>"
    )
    write(
        spark, out("pushes"), "1",
        [(1, "p", "c", "k", "web.bucket.push.site", (5,))], push_schema,
    )
    source = stream(spark, out("pushes"), push_schema)
    jobs.finish(jobs.send_pushes(source, "site", out("outbox"), out("c3")))
    assert spark.read.parquet(out("outbox")).first()["payload"] == '[{"id":5}]'


def test_one_round_of_fetching(spark):
    state = spark.createDataFrame(
        [("u", 0, None, None, 0, False), ("gone", 0, None, None, 0, False)],
        "url string, last_fetch_time bigint, last_fetch_etag string, "
        "last_fetch_modified string, next_fetch_time bigint, submitted boolean",
    )
    active = spark.createDataFrame(
        [(2, 1, '{"value":"u"}'), (3, 1, '{"value":"new"}')],
        "channel_id bigint, river_id bigint, parameters string",
    )
    items = "".join(f"<item><guid>{i}</guid></item>" for i in range(3))
    docs = spark.createDataFrame(
        [("u", 1, f"<rss><channel>{items}</channel></rss>", 200, "e", None, 50)],
        "url string, fetch_id bigint, doc string, status int, etag string, "
        "modified string, fetched_at bigint",
    )
    cached = rss.feeds.as_cache_rows(
        rss.feeds.entries_to_drops(
            rss.feeds.entries(rss.feeds.answers_of(state, docs)), 10
        ),
        rss.feeds.hash_id(),
    ).limit(0)
    drops, responses, after, cache = rss.refresh(state, active, docs, cached, 100, keep=2)
    assert drops.count() == 3 and cache.count() == 2
    assert drops.first()["channel_ids"] == [2]
    assert responses.first()["last_fetch_etag"] == "e"
    known = {r["url"]: r for r in after.collect()}
    assert set(known) == {"u", "new"}
    assert known["u"]["last_fetch_time"] == 50 and not known["u"]["submitted"]
    assert known["new"]["submitted"]
