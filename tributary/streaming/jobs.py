"""The operators under Structured Streaming.

Every job is one query: a stream, a function per micro-batch built from the
batch operators, and sinks that a repeated batch overwrites with the same rows.
With a checkpoint that makes each message count once (STR-1); the reference
side of a join is read anew in each batch, so a change of the registry takes
effect with the next batch and without a gap (STR-9).
"""

import json

from pyspark.sql import functions as F

from tributary.operators import events, feeds, mail, push, registry, schedule, tweets
from tributary.plans import deployments, firehose, rss
from tributary.sources import deltas, readers, sinks, staging
from tributary.streaming import state


class Batch(int):
    """The number of a micro-batch, and ``run``, the id of the query's checkpoint.

    A query that starts anew counts from 0 again, under another id.
    """

    run = ""


def _run_id(spark, checkpoint):
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def run(stream, per_batch, checkpoint, every=None):
    """Start ``per_batch(df, batch_id)`` on the stream.

    ``every`` is a trigger interval (STR-7/8); without one the query takes what
    is there and ends.
    """
    known = []

    def numbered(batch, batch_id):
        if not known:
            known.append(_run_id(batch.sparkSession, checkpoint))
        number = Batch(batch_id)
        number.run = known[0]
        per_batch(batch, number)

    writer = stream.writeStream.foreachBatch(numbered).option(
        "checkpointLocation", checkpoint
    )
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def finish(query):
    """Wait for a query without a trigger interval; raise what it raised."""
    query.awaitTermination()
    return query


def without_repeats(drops, delay="1 day"):
    """STR-1: drops of a stream, a repeated (channel, id) let through once.

    The watermark runs on the time of arrival, so no drop is late, whatever its
    date of publication.  Ids are remembered for ``delay`` after they arrived.
    """
    arrived = drops.withColumn("_arrived", F.current_timestamp())
    return (
        arrived.withWatermark("_arrived", delay)
        .dropDuplicatesWithinWatermark(["channel", "droplet_orig_id"])
        .drop("_arrived")
    )


def _version_before(spark, path, batch_id):
    """A versioned table as it was before ``batch_id`` (repeats see the same)."""
    return readers.latest_version(spark, path, before=batch_id)


def start_table(rows, path):
    """Publish ``rows`` as the version before the first batch."""
    sinks.publish_version(rows, path, -1)


def match_tweets(lines, registry_of, kind, out, checkpoint, every=None):
    """SRC-6, STR-9/12/14: tweet lines to drops with rivers, and the notices,
    rate limits and broken lines to tables of their own; ``kind`` is track, follow, or
    both in a list.  A batch is parsed once.  ``drops`` hold the key of their ``lists``
    (see ``keyed``)."""
    kinds = [kind] if isinstance(kind, str) else list(kind)

    def per_batch(batch, batch_id):
        spark = batch.sparkSession
        classified = staging.written(tweets.classify(batch), "tweets")
        sinks.append_batch(
            tweets.delete_notices(classified), f"{out}/deletes", batch_id
        )
        sinks.append_batch(
            tweets.limit_notices(classified), f"{out}/rate_limits", batch_id
        )
        sinks.append_batch(
            tweets.quarantined(classified), f"{out}/quarantine", batch_id
        )
        drops = tweets.to_drops(classified)
        sets, targets = firehose.sets_of(drops, registry_of(spark), kinds, "droplet_orig_id")
        sinks.append_batch(targets, f"{out}/lists", batch_id, staging.LISTS)
        sinks.append_drops(tweets.keyed(drops, sets, "droplet_orig_id"), f"{out}/drops", batch_id)

    return run(lines, per_batch, checkpoint, every)


def match_drops(drops, registry_of, kind, out, checkpoint, every=None):
    """JOIN-7/8 on a stream of drops: their ids in ``drops``, with the key of their rivers
    and channels in ``lists`` (see ``keyed`` and ``rivers_of``)."""

    def per_batch(batch, batch_id):
        registry = registry_of(batch.sparkSession)
        sets, targets = firehose.sets_of(batch, registry, [kind])
        sinks.append_batch(targets, f"{out}/lists", batch_id, staging.LISTS)
        sinks.append_batch(sets.select("id", "key"), f"{out}/drops", batch_id)

    return run(drops, per_batch, checkpoint, every)


def keyed(spark, out):
    """The tables of ``match_tweets`` and ``match_drops``: drops with ``key``, and the
    lists (key, part, river_id, channel_ids) that many of them share.

    A batch's lists stand there once and not once per drop, and before its drops.  The
    registry may change between batches, so the batch is part of the key.
    """
    key = F.concat_ws(" ", F.col("batch_id").cast("string"), "key")
    held = (spark.read.parquet(f"{out}/{name}") for name in ("drops", "lists"))
    return [rows.withColumn("key", key).drop("batch_id") for rows in held]


def rivers_of(spark, out, listed=None):
    """(id, part, river_id, channel_ids) of the drops of ``match_drops``; ``listed`` as
    in ``firehose.sets_of``."""
    sets, targets = keyed(spark, out)
    targets = staging.written(listed(targets), "lists", staging.LISTS) if listed else targets
    return tweets.routed(sets, targets)


def fold_registry(messages, table, checkpoint, every=None):
    """STR-4/8 (Q-13): the predicate registry, one version per batch that holds
    changes; ``every="8 seconds"`` debounces snapshots."""

    def per_batch(batch, batch_id):
        bound = events.bound_to(batch, ["web.channel.twitter.*", "web.river.*"])
        changes = events.channel_changes(bound, "twitter")
        if changes.isEmpty():
            return
        before = _version_before(batch.sparkSession, table, batch_id)
        sinks.publish_version(
            events.fold_predicates(before, changes), table, batch_id
        )

    return run(messages, per_batch, checkpoint, every)


def fold_subscriptions(
    messages, table, url_state_of, jobs_out, checkpoint, every=None
):
    """STR-5/10: RSS subscriptions, one version per batch that holds changes,
    and at once a job to serve new subscribers from the cache."""

    def per_batch(batch, batch_id):
        bound = events.bound_to(batch, ["web.river.*", "web.channel.rss.*"])
        changes = events.channel_changes(bound, "rss")
        if changes.isEmpty():
            return
        spark = batch.sparkSession
        before = _version_before(spark, table, batch_id)
        sinks.publish_version(
            events.fold_subscriptions(before, changes), table, batch_id
        )
        added = events.subscription_changes(changes).where(F.col("op") == "add")
        jobs = schedule.replay_jobs(url_state_of(spark), added)
        sinks.append_batch(jobs, jobs_out, batch_id)

    return run(messages, per_batch, checkpoint, every)


def apply_fetch_responses(responses, table, checkpoint, every=None):
    """SRC-10, SNK-6, STR-6: the fetch state, one version per batch."""

    def per_batch(batch, batch_id):
        before = _version_before(batch.sparkSession, table, batch_id)
        sinks.publish_version(
            schedule.apply_responses(before, batch), table, batch_id
        )

    return run(responses, per_batch, checkpoint, every)


def fetch_feeds(feed_docs, jobs_of, subscribers_of, as_of, out, checkpoint, every=None):
    """SRC-5/11, STR-14: captured feeds to stamped drops, the responses to them, and
    what is no feed, which is not answered.  A batch is parsed once."""

    def per_batch(batch, batch_id):
        spark = batch.sparkSession
        answers = feeds.answers_of(jobs_of(spark), batch)
        read = staging.written(feeds.parsed(answers), "feeds")
        sinks.append_batch(feeds.quarantined_of(read), f"{out}/quarantine", batch_id)
        drops = feeds.entries_to_drops(feeds.entries_of(read), as_of)
        subscribers = staging.written(subscribers_of(spark), "subscribers")
        sinks.append_drops(
            drops, f"{out}/drops", batch_id, lambda dealt: feeds.stamp(dealt, subscribers)
        )
        sinks.append_batch(
            feeds.fetch_responses(feeds.answered(read)), f"{out}/responses", batch_id
        )

    return run(feed_docs, per_batch, checkpoint, every)


def receive_mail(mails, rivers_of, out, checkpoint, every=None):
    """SRC-7: mail to drops and attachments; undecodable mail is set aside."""

    def per_batch(batch, batch_id):
        routed = mail.with_rivers(batch, rivers_of(batch.sparkSession))
        parsed = staging.written(mail.parse(routed), "mail")
        sinks.append_drops(mail.to_drops(parsed), f"{out}/drops", batch_id)
        sinks.store_attachments(
            mail.attachment_store(mail.attachments(parsed)),
            f"{out}/attachments",
            batch_id,
        )
        sinks.append_batch(mail.quarantined(parsed), f"{out}/quarantine", batch_id)

    return run(mails, per_batch, checkpoint, every)


def receive_messages(messages, out, checkpoint, every=None):
    """SRC-8..12/14, STR-14: messages read by ``readers.messages``, each body parsed once
    and stored by outcome; one that is no such object goes to the quarantine."""

    def per_batch(batch, batch_id):
        read = staging.written(batch, "messages")
        sinks.append_batch(readers.broken(read), f"{out}/quarantine", batch_id)
        sinks.append_batch(read.where(F.col("m").isNotNull()), f"{out}/messages", batch_id)

    return run(messages, per_batch, checkpoint, every)


def enrich(drops, enricher, out, checkpoint, every=None):
    """STR-2, SNK-2: one of the two enrichers on the shared stream of drops.

    Start one query per enricher; each answers by itself to the queue named by
    ``reply_to``.  ``enricher(batch)`` is built from ``plans.enrichment``.
    """

    def per_batch(batch, batch_id):
        sinks.append_replies(enricher(batch), out, batch_id)

    return run(drops, per_batch, checkpoint, every)


def send_pushes(requests, kind, out, checkpoint, every=None):
    """SRC-14, SNK-9: push requests to the outbox of signed payloads."""

    def per_batch(batch, batch_id):
        sinks.append_batch(deployments.outgoing(batch, kind), out, batch_id)

    return run(requests, per_batch, checkpoint, every)


def log_pushes(pushed, log, settings, as_of, checkpoint, every=None):
    """SNK-8: both tables of a push get their version for the same batch.

    Plain Spark has no transaction over two tables; readers take the newest
    version that both have.  A repeated batch starts from the versions before
    it, so nothing is counted twice.
    """

    def per_batch(batch, batch_id):
        spark = batch.sparkSession
        sinks.publish_version(
            push.update_log(_version_before(spark, log, batch_id), batch, as_of),
            log,
            batch_id,
        )
        sinks.publish_version(
            push.update_pending(_version_before(spark, settings, batch_id), batch),
            settings,
            batch_id,
        )

    return run(pushed, per_batch, checkpoint, every)


def latest_common_version(spark, *paths):
    """The newest version that all of several tables have (see log_pushes)."""
    held = [set(readers.versions(spark, path)) for path in paths]
    return max(set.intersection(*held), default=None)


def keep_subscriptions(messages, current, table, checkpoint, every=None):
    """STR-5, SET-7: RSS subscriptions as keyed state, their changes to a delta table.

    ``current`` is the table (url, river_id, channel_id) before the first batch, from
    which ``table`` was started (``deltas.start``).
    """
    bound = events.bound_to(messages, ["web.river.*", "web.channel.rss.*"])
    changes = events.subscription_changes(events.channel_changes(bound, "rss"))

    def per_batch(batch, number):
        deltas.append(batch, table, number)

    return run(state.subscriptions(changes, current), per_batch, checkpoint, every)


def schedule_fetches(responses, current, out, checkpoint, every=None):
    """STR-6/7, SNK-3: fetch jobs when their URLs are due, by timers per URL."""

    def per_batch(batch, number):
        sinks.append_batch(batch, out, number)

    return run(state.fetch_jobs(responses, current), per_batch, checkpoint, every)


def deliver(messages, out, checkpoint, wait=state.RETRY_WAIT, most=state.MAX_RETRIES, every=None):
    """STR-11: attempts and outcomes of the messages of an outbox."""

    def per_batch(batch, number):
        sinks.append_batch(batch, out, number)

    return run(state.deliveries(messages, wait, most), per_batch, checkpoint, every)


def log_push_changes(pushed, log, settings, marks, as_of, checkpoint, every=None):
    """SNK-8: a push's changes of the log and of the pending counts, as deltas.

    A batch reads the buckets it touches and writes changed rows only.  ``marks`` names
    the batches that both tables hold; what a broken batch wrote to one of them is not
    read before the batch is through, and is replaced when it runs again.
    """

    def per_batch(batch, number):
        spark = batch.sparkSession
        rows = staging.written(batch.select("bucket_id", "droplet_id"), "pushed")
        places = []
        for path, changed in ((log, push.log_changes), (settings, push.pending_changes)):
            places.append(deltas.position(spark, path, number))
            buckets = deltas.touched_buckets(spark, path, rows)
            before = deltas.read(spark, path, buckets, before=places[-1])
            deltas.append(changed(before, rows, as_of), path, number)
        deltas.mark_common(spark, marks, places)

    return run(pushed, per_batch, checkpoint, every)


def keep_predicates(changes, table, checkpoint, every=None):
    """STR-4/8, SET-3: the registry as a delta table, its changes the feed of readers.

    ``changes`` is a stream of ``events.predicate_changes`` (or of ``state.follows_by_id``);
    ``table`` was started with the key term, type, channel_id.  A batch reads the buckets
    of the terms it names; one that changes nothing publishes nothing.
    """

    def per_batch(batch, number):
        spark = batch.sparkSession
        named = staging.written(batch, "predicate-changes")
        key, _, _ = deltas.meta(spark, table)
        buckets = deltas.touched_buckets(spark, table, named)
        before = deltas.read(spark, table, buckets, before=deltas.position(spark, table, number))
        changed = staging.written(registry.entry_changes(before, named, key), "predicate-feed")
        if not changed.isEmpty():
            deltas.append(changed, table, number)

    return run(changes, per_batch, checkpoint, every)


def serve_added(messages, cache, url_state_of, out, checkpoint, every=None):
    """STR-10, JOIN-5/6: new subscribers get the cached drops of their feeds at once.

    Jobs and cache meet within the batch; drops are stamped with the rivers and
    channels of the added subscriptions alone.  ``cache`` is the path of a bucketed cache
    (``rss.start_cache``).  Jobs that it cannot serve are left for the fetchers.
    """
    bound = events.bound_to(messages, ["web.river.*", "web.channel.rss.*"])
    changes = events.subscription_changes(events.channel_changes(bound, "rss"))

    def per_batch(batch, number):
        added = staging.written(events.added_subscriptions(batch), "added")
        asked = staging.written(schedule.replay_jobs(url_state_of(batch.sparkSession), added), "replay")
        served, left = rss.serve(asked, cache, registry.subscriber_parts(added))
        sinks.append_batch(served, f"{out}/drops", number)
        sinks.append_batch(left, f"{out}/jobs", number)

    return run(changes, per_batch, checkpoint, every)
