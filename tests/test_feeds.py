import hashlib

from pyspark.sql import functions as F

from tributary.operators import feeds, schedule

STATE = (
    "url string, last_fetch_time bigint, last_fetch_etag string, "
    "last_fetch_modified string, next_fetch_time bigint, submitted boolean"
)
NOW = 1704067200


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def feed(items, head="<title>T</title>"):
    return f'<?xml version="1.0"?><rss version="2.0"><channel>{head}{items}</channel></rss>'


def answers(spark, doc, last=0, etag=None):
    docs = spark.createDataFrame(
        [("u", 1, doc, 200, None, None, NOW)],
        "url string, fetch_id bigint, doc string, status int, etag string, "
        "modified string, fetched_at bigint",
    )
    jobs = spark.createDataFrame(
        [("u", last, etag, None)],
        "url string, last_fetch_time bigint, last_fetch_etag string, "
        "last_fetch_modified string",
    )
    return feeds.answers_of(jobs, docs)


def drops_of(spark, doc, **job):
    return feeds.entries_to_drops(feeds.entries(answers(spark, doc, **job)), NOW)


def test_entry_fields_and_fallbacks(spark):
    doc = feed("<item><guid>x</guid><description>d &lt;b&gt;</description></item>")
    drop = drops_of(spark, doc).first()
    assert drop["droplet_orig_id"] == hashlib.md5(b"x").hexdigest()
    assert drop["droplet_content"] == drop["droplet_raw"] == "d <b>"
    assert drop["identity_username"] == "u" and drop["identity_name"] == "T"
    assert drop["links"] is None and drop["droplet_title"] is None
    assert drop["droplet_date_pub"].timestamp() == NOW


def test_content_goes_before_summary(spark):
    head = '<rss xmlns:content="c"><channel><item>'
    doc = head + "<description>s</description><content:encoded>c</content:encoded></item></channel></rss>"
    assert drops_of(spark, doc).first()["droplet_content"] == "c"


def test_atom_entries(spark):
    doc = (
        '<feed xml:lang="fr"><title>A</title><link rel="self" href="no"/><link href="home"/>'
        '<entry><id>i</id><link href="l"/><content type="html">text</content>'
        "<updated>2024-01-01T00:00:00Z</updated></entry></feed>"
    )
    drop = drops_of(spark, doc).first()
    assert (drop["identity_username"], drop["droplet_locale"]) == ("home", "fr")
    assert drop["links"][0]["url"] == "l" and drop["droplet_content"] == "text"
    assert drop["droplet_orig_id"] == hashlib.md5(b"li").hexdigest()


def test_a_feed_without_entries_or_a_broken_one_gives_no_drop(spark):
    assert drops_of(spark, feed("")).isEmpty()
    assert drops_of(spark, "<html>").isEmpty()


def test_rss_1_0(spark):
    doc = (
        '<rdf:RDF xmlns:rdf="r" xmlns:dc="d"><channel><title>T</title><link>home</link></channel>'
        '<item rdf:about="i"><link>l</link><title>t</title><description>d</description>'
        "<dc:date>2024-01-01T00:00:00Z</dc:date></item></rdf:RDF>"
    )
    drop = drops_of(spark, doc).first()
    assert (drop["identity_username"], drop["droplet_title"]) == ("home", "t")
    assert drop["droplet_orig_id"] == hashlib.md5(b"li").hexdigest()


def test_what_is_no_whole_feed_is_set_aside(spark):
    whole = feed("<item><guid>a</guid></item>")
    docs = [whole, whole[:-20], "<html>", "", None, "<feed><title>A</title></feed>"]
    rows = spark.createDataFrame(list(enumerate(docs)), "fetch_id bigint, doc string")
    assert sorted(r.fetch_id for r in feeds.quarantined(rows).collect()) == [1, 2, 3]


def test_old_entries_are_skipped_only_for_full_fetches(spark):
    at = "<item><guid>a</guid><pubDate>Mon, 01 Jan 2024 00:00:00 +0000</pubDate></item>"
    assert drops_of(spark, feed(at), last=NOW).count() == 1
    assert drops_of(spark, feed(at), last=NOW + 1).count() == 0
    assert drops_of(spark, feed(at), last=NOW + 1, etag="e").count() == 1
    assert drops_of(spark, feed(at), last=NOW + 1, etag="").count() == 0


def cache(spark, n, url="u"):
    return spark.range(n).select(
        "id", F.lit(url).alias("url"), F.col("id").alias("date_pub"),
        F.struct(F.col("id").cast("string").alias("droplet_title")).alias("drop"),
    )


def test_cache_is_trimmed_before_the_insert(spark):
    old = cache(spark, 60).unionByName(cache(spark, 70, "other"))
    new = cache(spark, 50).withColumn("id", F.col("id") + 1000)
    merged = feeds.update_cache(old, new)
    counts = {r["url"]: r["count"] for r in merged.groupBy("url").count().collect()}
    assert counts == {"u": 100, "other": 70}
    kept = merged.where("url = 'u' and id < 1000").agg(F.min("id")).first()[0]
    assert kept == 10
    assert feeds.trim_cache(feeds.trim_cache(old)).count() == 100


def test_first_drops_of_a_fetch_in_feed_order(spark):
    drops = spark.range(70).select(
        F.lit("u").alias("identity_orig_id"), F.lit(1).alias("fetch_id"),
        (69 - F.col("id")).alias("pos"),
    )
    kept = feeds.first_of_fetch(drops)
    assert kept.count() == 50 and kept.agg(F.max("pos")).first()[0] == 49


def test_cache_serves_only_jobs_that_ask_for_it(spark):
    jobs = spark.createDataFrame(
        [("u", True), ("empty", True), ("v", False)], "url string, use_cache boolean"
    )
    stored = cache(spark, 2).unionByName(cache(spark, 2, "v"))
    subs = spark.createDataFrame(
        [("u", 0, [4], [5]), ("v", 0, [6], [7])],
        "url string, part bigint, river_ids array<bigint>, channel_ids array<bigint>",
    )
    served, left = feeds.serve_from_cache(jobs, stored, subs)
    assert {(r["id"], r["river_id"][0]) for r in served.collect()} == {(0, 4), (1, 4)}
    assert rows(left) == [("empty", True), ("v", False)]


def state(spark, *listed):
    return spark.createDataFrame(list(listed), STATE)


def test_reconcile_twice_is_reconcile_once(spark):
    before = state(spark, ("a", 5, "e", None, 6, False), ("b", 1, None, None, 2, False))
    wanted = spark.createDataFrame([("a",), ("c",), ("c",)], "url string")
    once = schedule.reconcile(before, wanted)
    assert rows(once.select("url", "change")) == [
        ("a", "kept"), ("b", "orphan"), ("c", "new"),
    ]
    after = schedule.current_state(once)
    again = schedule.reconcile(after, wanted)
    assert {r["change"] for r in again.collect()} == {"kept"}
    assert rows(schedule.current_state(again)) == rows(after)


def test_due_is_strict_and_spares_submitted_urls(spark):
    known = state(
        spark, ("a", 0, None, None, 99, False), ("b", 0, None, None, 100, False),
        ("c", 0, None, None, 1, True), ("d&amp;e", 0, "", "m", 98, False),
    )
    jobs = schedule.due_jobs(known, 100)
    assert [r["url"] for r in schedule.in_order(jobs).collect()] == ["d&amp;e", "a"]
    assert {r["url"]: (r["mode"], r["fetch_url"]) for r in jobs.collect()} == {
        "a": ("full", "a"), "d&amp;e": ("modified", "d&e"),
    }
    sent = schedule.mark_submitted(known, jobs)
    assert schedule.due_jobs(sent, 100).isEmpty()


def test_last_response_wins_and_clears_the_flag(spark):
    known = state(spark, ("a", 0, "old", "m", 0, True), ("b", 0, None, None, 7, True))
    responses = spark.createDataFrame(
        [("a", 1, 200, "x", None, 50), ("a", 2, 200, None, "n", 60),
         ("new", 3, 200, None, None, 70)],
        "url string, seq bigint, status int, last_fetch_etag string, "
        "last_fetch_modified string, last_fetch_time bigint",
    )
    after = {r["url"]: r for r in schedule.apply_responses(known, responses).collect()}
    assert after["a"]["last_fetch_time"] == 60 and after["a"]["last_fetch_etag"] is None
    assert not after["a"]["submitted"] and after["b"]["submitted"]
    assert 60 + 1800 <= after["a"]["next_fetch_time"] <= 60 + 3600
    assert after["b"]["next_fetch_time"] == 7 and "new" in after


def test_responses_fall_back_to_the_job(spark):
    got = feeds.fetch_responses(answers(spark, feed(""), etag="e")).first()
    assert (got["last_fetch_etag"], got["last_fetch_modified"]) == ("e", None)
