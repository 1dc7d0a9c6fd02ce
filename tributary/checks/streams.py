"""Streaming twins of queries: the same tables, read as file streams."""

from pyspark.sql import functions as F

from tributary import schemas
from tributary.checks import bindings, entries, inputs
from tributary.operators import events, push, registry, schedule, tweets
from tributary.plans import rss
from tributary.sources import deltas, readers, staging
from tributary.streaming import jobs, state


def _stream(spark, sf_dir, view, table):
    """A view of one table, a file or a folder of files, over that table as a stream."""
    # A plain path would have to be a folder; a pattern may name a file as well.
    rows = spark.readStream.schema(bindings.table(spark, sf_dir, table).schema).parquet(
        f"{sf_dir}/{table}.parque[t]"
    )
    return bindings.view(spark, sf_dir, view, {table: rows})


def stream_match_rivers(spark, sf_dir):
    out = staging.shared_folder(spark, "match")
    drops = _stream(spark, sf_dir, "fx_drops", "documents")
    jobs.finish(
        jobs.match_drops(
            drops,
            lambda session: entries.predicates(session, sf_dir),
            "track",
            f"{out}/routes",
            f"{out}/checkpoint",
        )
    )
    return entries.routes_as_text(jobs.rivers_of(spark, f"{out}/routes", entries.lists_as_text))


def stream_tweets(spark, sf_dir):
    """Every sink of the tweet stream, as counts and one digest per kind."""
    out = staging.shared_folder(spark, "tweets")
    lines = inputs.tweet_text(_stream(spark, sf_dir, "fx_tweets", "conversations"))
    jobs.finish(
        jobs.match_tweets(
            lines,
            lambda session: entries.predicates(session, sf_dir),
            "track",
            out,
            f"{out}/checkpoint",
        )
    )
    drops = tweets.stamp(*jobs.keyed(spark, out), "droplet_orig_id").select("droplet_orig_id").distinct()
    kinds = [
        drops.select(F.lit("drop").alias("kind"), F.col("droplet_orig_id").alias("v")),
        spark.read.parquet(f"{out}/deletes").select(
            F.lit("delete").alias("kind"), F.col("status_id").alias("v")
        ),
        spark.read.parquet(f"{out}/rate_limits").select(
            F.lit("limit").alias("kind"), F.col("track").cast("string").alias("v")
        ),
        spark.read.parquet(f"{out}/quarantine").select(
            "kind", F.md5("raw").alias("v")
        ),
    ]
    rows = kinds[0]
    for more in kinds[1:]:
        rows = rows.unionByName(more)
    return rows


def _messages(spark, sf_dir):
    return inputs.control_text(_stream(spark, sf_dir, "fx_control", "events"))


def stream_registry_fold(spark, sf_dir):
    out = staging.shared_folder(spark, "registry")
    jobs.start_table(entries.predicates(spark, sf_dir), f"{out}/table")
    jobs.finish(
        jobs.fold_registry(
            _messages(spark, sf_dir), f"{out}/table", f"{out}/checkpoint"
        )
    )
    return readers.latest_version(spark, f"{out}/table")


def stream_subscription_fold(spark, sf_dir):
    out = staging.shared_folder(spark, "subscriptions")
    active = entries.active(spark, sf_dir, "rss")
    jobs.start_table(registry.subscriptions(active), f"{out}/table")
    jobs.finish(
        jobs.fold_subscriptions(
            _messages(spark, sf_dir),
            f"{out}/table",
            lambda session: entries.state(session, sf_dir),
            f"{out}/jobs",
            f"{out}/checkpoint",
        )
    )
    return readers.latest_version(spark, f"{out}/table")


def stream_fetch_status(spark, sf_dir):
    out = staging.shared_folder(spark, "state")
    state = schedule.load_state(bindings.view(spark, sf_dir, "fx_rss_urls"))
    jobs.start_table(state, f"{out}/table")
    responses = _stream(spark, sf_dir, "fx_fetch_responses", "events")
    jobs.finish(
        jobs.apply_fetch_responses(responses, f"{out}/table", f"{out}/checkpoint")
    )
    return readers.latest_version(spark, f"{out}/table")


def stream_dedupe(spark, sf_dir):
    """Each drop arrives twice, in files of falling date, one per batch; one of
    each (channel, id) goes on."""
    out = staging.shared_folder(spark, "dedupe")
    rows = bindings.view(spark, sf_dir, "fx_drops").select(
        "channel",
        "droplet_orig_id",
        F.timestamp_seconds("date_pub").alias("droplet_date_pub"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
    )
    third = F.pmod(F.floor(F.unix_seconds("droplet_date_pub") / 86400), F.lit(3))
    for part in (2, 1, 0):
        rows.where(third == part).coalesce(1).write.mode("append").parquet(f"{out}/in")
    drops = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    query = (
        jobs.without_repeats(drops.parquet(f"{out}/in"))
        .select("channel", "droplet_orig_id")
        .writeStream.format("parquet")
        .option("path", f"{out}/drops")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    jobs.finish(query)
    return spark.read.parquet(f"{out}/drops")


def _in_parts(rows, part, parts, folder, job):
    """Feed ``rows`` to ``job(stream)`` in several runs, each from the last one's
    checkpoint; ``part`` numbers the run a row arrives in."""
    spark = rows.sparkSession
    held = staging.written(rows.withColumn("_part", part), "parts")
    for k in range(parts):
        held.where(F.col("_part") == k).drop("_part").write.mode("append").parquet(folder)
        jobs.finish(job(spark.readStream.schema(rows.schema).parquet(folder)))


def stream_subscription_state(spark, sf_dir):
    """Events arrive in three runs, each run with older ones than the runs before."""
    out = staging.shared_folder(spark, "subscription-state")
    current = staging.written(
        registry.subscriptions(entries.active(spark, sf_dir, "rss")), "subscriptions"
    )
    deltas.start(current, f"{out}/table", ["url", "channel_id"], 16)
    messages = inputs.control_text(bindings.view(spark, sf_dir, "fx_control"))
    part = F.pmod(-F.col("seq"), F.lit(3))
    _in_parts(
        messages, part, 3, f"{out}/in",
        lambda stream: jobs.keep_subscriptions(stream, current, f"{out}/table", f"{out}/checkpoint"),
    )
    return deltas.read(spark, f"{out}/table")


def stream_fetch_jobs(spark, sf_dir):
    """Responses arrive by their time in four runs; a job goes out for what is due."""
    out = staging.shared_folder(spark, "fetch-jobs")
    responses = bindings.view(spark, sf_dir, "fx_fetch_responses")
    time = F.col("last_fetch_time")
    first, last = responses.agg(F.min(time), F.max(time)).first()
    width = (last - first) // 4 + 1
    part = F.floor((time - first) / width)
    _in_parts(
        responses, part, 4, f"{out}/in",
        lambda stream: jobs.schedule_fetches(
            stream, entries.state(spark, sf_dir), f"{out}/jobs", f"{out}/checkpoint"
        ),
    )
    return spark.read.parquet(f"{out}/jobs").drop("batch_id")


def stream_outbox_retries(spark, sf_dir):
    """Drops go out, and the answers to attempt k arrive in run k, the clock 45 seconds
    further at the end of each run; two failures are allowed."""
    out = staging.shared_folder(spark, "deliveries")
    answers = bindings.view(spark, sf_dir, "fx_entity_responses")
    run = F.least(F.col("attempt").cast("bigint"), F.lit(4))
    start = 1_704_067_200
    heard = answers.select(
        F.col("correlation_id").cast("bigint").alias("message_id"),
        F.col("attempt").cast("bigint").alias("attempt"),
        F.col("status").cast("int").alias("status"),
        F.timestamp_seconds(F.lit(start) + 60 * run).alias("at"),
    )
    sent = heard.where("attempt = 1").select(
        "message_id", F.lit(0).cast("bigint").alias("attempt"), F.lit(None).cast("int").alias("status"),
        F.timestamp_seconds(F.lit(start)).alias("at"),
    )
    # The clock goes on with a message nobody sent.
    ticks = spark.range(5).select(
        F.lit(-1).cast("bigint").alias("message_id"), F.lit(0).cast("bigint").alias("attempt"),
        F.lit(200).alias("status"), F.timestamp_seconds(F.lit(start) + 60 * F.col("id") + 45).alias("at"),
    )
    rows = sent.unionByName(heard).unionByName(ticks)
    part = F.floor((F.unix_seconds("at") - start) / 60)
    # Messages and first ticks come without waiting for the answers: no resend in run 0.
    _in_parts(
        rows.where(~((F.col("message_id") == -1) & (F.unix_seconds("at") < start + 60))), part, 5, f"{out}/in",
        lambda stream: jobs.deliver(stream, f"{out}/events", f"{out}/checkpoint", 30, 2),
    )
    return spark.read.parquet(f"{out}/events").drop("batch_id")


def _pushed_tables(spark, sf_dir):
    """Pushes in three runs, the third with a new checkpoint, folded after the second."""
    out = staging.shared_folder(spark, "push-deltas")
    log, settings, marks = f"{out}/log", f"{out}/settings", f"{out}/marks"
    deltas.start(bindings.view(spark, sf_dir, "fx_push_log"), log, ["bucket_id", "droplet_id"], 16)
    deltas.start(bindings.view(spark, sf_dir, "fx_push_settings"), settings, ["bucket_id"], 16)
    requests = push.wanted(bindings.view(spark, sf_dir, "fx_push_requests"), "deployment")
    pushed = staging.written(requests.select("bucket_id", "droplet_id"), "pushed")
    for k, checkpoint in enumerate(("a", "a", "b")):
        folder = f"{out}/in-{checkpoint}"
        pushed.where(F.pmod("droplet_id", F.lit(3)) == k).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(pushed.schema).parquet(folder)
        jobs.finish(
            jobs.log_push_changes(
                stream, log, settings, marks, bindings.AS_OF, f"{out}/checkpoint-{checkpoint}"
            )
        )
        if k == 1:
            deltas.fold(spark, log)
            deltas.fold(spark, settings)
    at = deltas.common(spark, marks)
    return (deltas.read(spark, path, upto=upto) for path, upto in zip((log, settings), at))


def stream_push_log(spark, sf_dir):
    log, _ = _pushed_tables(spark, sf_dir)
    return log


def stream_push_pending(spark, sf_dir):
    _, settings = _pushed_tables(spark, sf_dir)
    return settings


#: Feeds of which the test cuts the end off, and feeds that begin with a byte-order mark.
BROKEN, MARKED = ("src3", "src9", "src14"), ("src4", "src5")


def feed_quarantine(spark, sf_dir):
    """What became of each captured feed: broken ones are kept apart, not answered."""
    out = staging.shared_folder(spark, "feeds")
    number = F.substring_index("url", "/", -1)
    size = F.char_length("doc")
    damaged = (
        F.when(number.isin(*BROKEN), F.substring("doc", F.lit(1), size - 9))
        .when(number.isin(*MARKED), F.concat(F.lit("\ufeff"), "doc"))
        .otherwise(F.col("doc"))
    )
    docs = inputs.feed_docs(spark, sf_dir).withColumn("doc", damaged)
    docs.write.parquet(f"{out}/in")
    stream = spark.readStream.schema(docs.schema).parquet(f"{out}/in")
    jobs.finish(
        jobs.fetch_feeds(
            stream,
            lambda session: schedule.due_jobs(entries.state(session, sf_dir), bindings.AS_OF),
            lambda session: registry.subscriber_parts(
                registry.subscriptions(entries.active(session, sf_dir, "rss"))
            ),
            bindings.AS_OF, out, f"{out}/checkpoint",
        )
    )
    kinds = [
        spark.read.parquet(f"{out}/{name}").select("url", "fetch_id", F.lit(kind).alias("outcome"))
        for name, kind in (("quarantine", "broken"), ("responses", "answered"))
    ]
    return kinds[0].unionByName(kinds[1])


def message_quarantine(spark, sf_dir):
    """Control messages through the reader; every tenth body is cut off."""
    out = staging.shared_folder(spark, "messages")
    sent = inputs.control_text(bindings.view(spark, sf_dir, "fx_control"))
    cut = F.when(F.col("seq") % 10 == 3, F.expr("substring(body, 1, length(body) - 2)"))
    none = F.lit(None).cast("string")
    envelope = sent.select(
        "routing_key", none.alias("correlation_id"), none.alias("reply_to"), "seq",
        F.coalesce(cut, "body").alias("body"),
    )
    envelope.write.parquet(f"{out}/in")
    read = readers.messages(spark, f"{out}/in", schemas.CHANNEL_EVENT, stream=True)
    jobs.finish(jobs.receive_messages(read, out, f"{out}/checkpoint"))
    broken = spark.read.parquet(f"{out}/quarantine")
    fine = spark.read.parquet(f"{out}/messages").select("routing_key", "seq", F.lit("read").alias("outcome"))
    return fine.unionByName(broken.select("routing_key", "seq", F.lit("broken").alias("outcome")))


def stream_track_and_follow(spark, sf_dir):
    """Tweets matched by text and by author in one run, each drop with all its rivers."""
    out = staging.shared_folder(spark, "firehose")
    lines = inputs.tweet_text(_stream(spark, sf_dir, "fx_tweets", "conversations"))
    jobs.finish(
        jobs.match_tweets(
            lines, lambda session: entries.predicates(session, sf_dir), ["track", "follow"],
            out, f"{out}/checkpoint",
        )
    )
    return tweets.channels_of(*jobs.keyed(spark, out), "droplet_orig_id")


def stream_cache_serve(spark, sf_dir):
    """Cached drops for the subscribers that messages add."""
    out = staging.shared_folder(spark, "cache-serve")
    rss.start_cache(inputs.cache(spark, sf_dir), f"{out}/cache", 16)
    messages = _messages(spark, sf_dir)
    jobs.finish(
        jobs.serve_added(
            messages, f"{out}/cache", lambda session: entries.state(session, sf_dir), f"{out}/served",
            f"{out}/checkpoint",
        )
    )
    drops = spark.read.parquet(f"{out}/served/drops")
    return drops.select(
        "id", "droplet_orig_id", entries.csv("river_id").alias("rivers"), entries.csv("channel_ids").alias("channels")
    )


PREDICATE_KEY = ["term", "type", "channel_id"]


def stream_predicate_changes(spark, sf_dir):
    """What really changes in the registry with each of three runs of messages."""
    out = staging.shared_folder(spark, "predicate-changes")
    deltas.start(entries.predicates(spark, sf_dir), f"{out}/table", PREDICATE_KEY, 16)
    messages = inputs.control_text(bindings.view(spark, sf_dir, "fx_control"))
    first, last = messages.agg(F.min("seq"), F.max("seq")).first()
    part = F.floor((F.col("seq") - first) * 3 / (last - first + 1))

    def job(stream):
        bound = events.bound_to(stream, ["web.channel.twitter.*", "web.river.*"])
        changes = events.predicate_changes(events.channel_changes(bound, "twitter"))
        return jobs.keep_predicates(changes, f"{out}/table", f"{out}/checkpoint")

    _in_parts(messages, part, 3, f"{out}/in", job)
    feed = deltas.feed(spark, f"{out}/table", "change string")
    return feed.select(
        F.col("batch").cast("bigint").alias("run"), "type", "term", "channel_id", "river_id", "change"
    )


def stream_registry_by_user_id(spark, sf_dir):
    """Follow terms by id; half of the names have theirs captured before the events
    that name them, half after."""
    out = staging.shared_folder(spark, "follows")
    terms = registry.valid_terms(registry.options_to_terms(entries.active(spark, sf_dir, "twitter")))
    terms = terms.select(
        "type", "term", "channel_id", "river_id", F.lit("add").alias("op"),
        F.struct(F.col("channel_id").alias("seq"), F.lit(0).alias("at")).alias("seq"),
    )
    ids = bindings.view(spark, sf_dir, "fx_user_ids").select("screen_name", F.col("user_id").cast("string"))
    start = terms.limit(0).select("type", "term", "channel_id", "river_id")
    deltas.start(start, f"{out}/table", PREDICATE_KEY, 16)
    half = F.pmod(F.crc32("term"), F.lit(2))
    held = {"in": (terms, half), "ids": (ids, F.pmod(F.crc32("screen_name"), F.lit(2)))}
    for run in (0, 1, 2):
        for name, (rows, group) in held.items():
            # Names of group 0 are captured in run 0 and used in run 1, the others after.
            when = group if name == "ids" else F.lit(1)
            late = F.when(when == 0, 0).otherwise(2) if name == "ids" else when
            rows.where(late == run).write.mode("append").parquet(f"{out}/{name}")
        streams = (spark.readStream.schema(rows.schema).parquet(f"{out}/{n}") for n, (rows, _) in held.items())
        changes = state.follows_by_id(*streams)
        jobs.finish(jobs.keep_predicates(changes, f"{out}/table", f"{out}/checkpoint"))
    return deltas.read(spark, f"{out}/table")


QUERIES = [
    stream_match_rivers,
    stream_tweets,
    stream_registry_fold,
    stream_subscription_fold,
    stream_fetch_status,
    stream_dedupe,
    stream_subscription_state,
    stream_fetch_jobs,
    stream_outbox_retries,
    stream_push_log,
    stream_push_pending,
    feed_quarantine,
    message_quarantine,
    stream_track_and_follow,
    stream_predicate_changes,
    stream_cache_serve,
    stream_registry_by_user_id,
]
