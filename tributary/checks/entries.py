"""Every operator as a query over the test tables.

Array results are written as comma-joined text, so that any engine can compare
them.  Each query runs over its whole tables.
"""

from pyspark.sql import functions as F

from tributary.checks import bindings, inputs
from tributary.functions import dates, signing, text, urls
from tributary.operators import (
    entities,
    events,
    feeds,
    mail,
    media,
    push,
    registry,
    scale,
    schedule,
    tweets,
)
from tributary.plans import enrichment, firehose, rss
from tributary.sources import deltas, staging
from tributary.streaming import jobs as streams_jobs

AS_OF = bindings.AS_OF
QUOTA = {"track": 3, "follow": 4}


def csv(column):
    """An array as text."""
    return F.array_join(column, ",", "")


def _view(name):
    return lambda spark, sf_dir: bindings.view(spark, sf_dir, name)


_rivers, _channels = _view("fx_rivers"), _view("fx_river_channels")
_drops, _rss_urls = _view("fx_drops"), _view("fx_rss_urls")


def _texts(spark, sf_dir):
    """The drops, for work that is heavy per text."""
    return scale.spread_if_few(_drops(spark, sf_dir), "id")


def active(spark, sf_dir, channel, channels=_channels):
    return registry.active_channels(
        _rivers(spark, sf_dir), channels(spark, sf_dir), channel
    )


def _subscriptions(spark, sf_dir):
    return registry.subscriptions(active(spark, sf_dir, "rss"))


def _terms(spark, sf_dir):
    return registry.options_to_terms(active(spark, sf_dir, "twitter"))


def _predicates(spark, sf_dir, **options):
    return registry.predicates(active(spark, sf_dir, "twitter"), **options)


# --- registry -------------------------------------------------------------


def active_channels(spark, sf_dir):
    both = [
        active(spark, sf_dir, name).withColumn("channel", F.lit(name))
        for name in ("rss", "twitter")
    ]
    return both[0].unionByName(both[1])


def url_subscribers(spark, sf_dir):
    parts = registry.url_subscribers(active(spark, sf_dir, "rss"))
    return parts.select(
        "url", "part", csv("river_ids").alias("rivers"),
        csv("channel_ids").alias("channels"),
    )


def term_normalise(spark, sf_dir):
    return _terms(spark, sf_dir)


def predicates(spark, sf_dir):
    return _predicates(spark, sf_dir)


def predicates_by_user_id(spark, sf_dir):
    ids = bindings.view(spark, sf_dir, "fx_user_ids")
    return _predicates(spark, sf_dir, user_ids=ids)


def predicate_quota(spark, sf_dir):
    return _predicates(spark, sf_dir, quota=QUOTA)


def quota_refused(spark, sf_dir):
    """FLT-10: the options that the quota leaves out."""
    terms = registry.valid_terms(_terms(spark, sf_dir))
    return registry.over_quota(terms, QUOTA).distinct()


def first_writer(spark, sf_dir):
    return _predicates(spark, sf_dir, first_writer_wins=True)


def predicate_counts(spark, sf_dir):
    return registry.term_counts(_predicates(spark, sf_dir))


def _pairs(map_column):
    pair = lambda e: F.concat_ws(":", e["key"], e["value"])
    return csv(F.transform(F.array_sort(F.map_entries(map_column)), pair))


def registry_maps(spark, sf_dir):
    maps = registry.registry_maps(_predicates(spark, sf_dir))
    return maps.select("type", "term", "part", _pairs("channels").alias("channels"))


def predicate_maps(spark, sf_dir):
    maps = registry.predicate_maps(_predicates(spark, sf_dir))
    return maps.select("term", "part", _pairs("channels").alias("channels"))


def _predicates_before(spark, sf_dir):
    before = _view("fx_river_channels_before")
    return registry.predicates(active(spark, sf_dir, "twitter", before))


def predicate_diff(spark, sf_dir):
    return registry.predicate_diff(
        _predicates_before(spark, sf_dir), _predicates(spark, sf_dir)
    )


def registry_add(spark, sf_dir):
    return registry.add_entries(
        _predicates_before(spark, sf_dir),
        _predicates(spark, sf_dir),
        registry.PREDICATE_KEY,
    )


def registry_delete(spark, sf_dir):
    return registry.remove_entries(
        _predicates_before(spark, sf_dir),
        _predicates(spark, sf_dir),
        registry.PREDICATE_KEY,
    )


def user_id_cache(spark, sf_dir):
    known = bindings.view(spark, sf_dir, "fx_user_ids")
    named = _drops(spark, sf_dir).select(
        F.col("identity_orig_id").alias("screen_name")
    ).distinct()
    found = named.withColumn("user_id", F.concat(F.lit("new-"), "screen_name"))
    return registry.remembered_ids(known, found)


def control_events(spark, sf_dir):
    messages = inputs.control_messages(spark, sf_dir)
    bound = events.bound_to(messages, ["web.river.*", "web.channel.rss.*"])
    return bound.groupBy("routing_key").agg(F.count(F.lit(1)).alias("n"))


def registry_fold(spark, sf_dir):
    messages = inputs.control_messages(spark, sf_dir)
    bound = events.bound_to(messages, ["web.channel.twitter.*", "web.river.*"])
    changes = events.channel_changes(bound, "twitter")
    return events.fold_predicates(_predicates(spark, sf_dir), changes)


def subscription_fold(spark, sf_dir):
    messages = inputs.control_messages(spark, sf_dir)
    bound = events.bound_to(messages, ["web.river.*", "web.channel.rss.*"])
    changes = events.channel_changes(bound, "rss")
    return events.fold_subscriptions(_subscriptions(spark, sf_dir), changes)


# --- matching -------------------------------------------------------------


def track_match(spark, sf_dir):
    return tweets.track_match(_texts(spark, sf_dir), _predicates(spark, sf_dir))


def follow_match(spark, sf_dir):
    return tweets.follow_match(_drops(spark, sf_dir), _predicates(spark, sf_dir))


def lists_as_text(lists):
    """Lists of rivers and channels as text, made once per list and not once per drop."""
    return lists.withColumns({c: csv(c) for c in ("river_id", "channel_ids")})


def routes_as_text(routed):
    """The rows of ``firehose.rivers_of`` whose lists are text already."""
    return routed.select(
        "id", "part", F.col("river_id").alias("rivers"),
        F.col("channel_ids").alias("channels"),
    )


def match_rivers(spark, sf_dir):
    """Which rivers does each drop belong to?"""
    texts, known = _texts(spark, sf_dir), _predicates(spark, sf_dir)
    return routes_as_text(firehose.rivers_of(texts, known, "track", listed=lists_as_text))


def follow_rivers(spark, sf_dir):
    drops, known = _drops(spark, sf_dir), _predicates(spark, sf_dir)
    return routes_as_text(firehose.rivers_of(drops, known, "follow", listed=lists_as_text))


# --- tweets ---------------------------------------------------------------


def _classified(spark, sf_dir):
    return tweets.classify(inputs.tweet_lines(spark, sf_dir))


def tweet_classes(spark, sf_dir):
    lines = _classified(spark, sf_dir)
    return lines.select(
        "kind", "text", "id_str", F.md5("raw").alias("raw_md5"),
    ).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("id_str").alias("with_id")
    )


def tweet_drops(spark, sf_dir):
    drops = tweets.to_drops(_classified(spark, sf_dir))
    return drops.select(
        "channel",
        "identity_orig_id",
        "in_reply_to_user_id",
        "identity_name",
        "identity_username",
        "identity_avatar",
        "droplet_orig_id",
        "droplet_type",
        F.md5("droplet_title").alias("title_md5"),
        F.md5("droplet_content").alias("content_md5"),
        F.md5("droplet_raw").alias("raw_md5"),
        "droplet_locale",
        F.unix_seconds("droplet_date_pub").alias("date_pub"),
        F.col("links")[0]["url"].alias("link"),
    )


def notices(spark, sf_dir):
    lines = _classified(spark, sf_dir)
    deleted = tweets.delete_notices(lines).select(
        F.lit("delete").alias("kind"), F.concat_ws("/", "status_id", "user_id").alias("v")
    )
    limited = tweets.limit_notices(lines).select(
        F.lit("limit").alias("kind"), F.col("track").cast("string").alias("v")
    )
    broken = tweets.quarantined(lines).select("kind", F.md5("raw").alias("v"))
    return deleted.unionByName(limited).unionByName(broken)


# --- fetch state ----------------------------------------------------------


def state(spark, sf_dir):
    return schedule.load_state(_rss_urls(spark, sf_dir))


def _reconciled(spark, sf_dir):
    return schedule.reconcile(state(spark, sf_dir), _subscriptions(spark, sf_dir))


def urls_missing(spark, sf_dir):
    return schedule.missing_urls(_reconciled(spark, sf_dir))


def urls_deleted(spark, sf_dir):
    return schedule.orphan_urls(_reconciled(spark, sf_dir))


def url_state(spark, sf_dir):
    return _reconciled(spark, sf_dir)


def next_fetch(spark, sf_dir):
    return state(spark, sf_dir).select("url", "last_fetch_time", "next_fetch_time")


def _jobs(spark, sf_dir):
    current = schedule.current_state(_reconciled(spark, sf_dir))
    return schedule.due_jobs(current, AS_OF)


def due_jobs(spark, sf_dir):
    return schedule.in_order(_jobs(spark, sf_dir))


def fetch_jobs(spark, sf_dir):
    jobs = rss.fetch_jobs(
        _rss_urls(spark, sf_dir), active(spark, sf_dir, "rss"), AS_OF
    )
    return jobs.select(
        "url", "part", "mode", "use_cache", "last_fetch_time",
        csv("river_ids").alias("rivers"), csv("channel_ids").alias("channels"),
    )


def fetch_mode(spark, sf_dir):
    return _rss_urls(spark, sf_dir).select("url", schedule.fetch_mode().alias("mode"))


def _responses(spark, sf_dir):
    return bindings.view(spark, sf_dir, "fx_fetch_responses")


def latest_responses(spark, sf_dir):
    return schedule.latest_responses(_responses(spark, sf_dir))


def fetch_status_upsert(spark, sf_dir):
    return schedule.apply_responses(
        state(spark, sf_dir), _responses(spark, sf_dir)
    )


def fetch_flags(spark, sf_dir):
    before = state(spark, sf_dir)
    sent = schedule.mark_submitted(before, schedule.due_jobs(before, AS_OF))
    answered = _responses(spark, sf_dir)
    return schedule.apply_responses(sent, answered).select("url", "submitted")


def replay_jobs(spark, sf_dir):
    messages = inputs.control_messages(spark, sf_dir)
    changes = events.subscription_changes(events.channel_changes(messages, "rss"))
    added = changes.where(F.col("op") == "add")
    return schedule.replay_jobs(state(spark, sf_dir), added)


# --- feeds ----------------------------------------------------------------


def feed_entries(spark, sf_dir):
    rows = feeds.entries(inputs.feed_docs(spark, sf_dir))
    return rows.select(
        "url", "fetch_id", F.col("pos").cast("bigint").alias("pos"), "feed_title",
        "feed_link", "feed_language", "feed_image", "entry_id", "link", "title",
        F.md5("summary").alias("summary_md5"), F.md5("content").alias("content_md5"),
        F.unix_seconds("date_parsed").alias("published"),
    )


def _state_jobs(spark, sf_dir):
    return schedule.due_jobs(state(spark, sf_dir), AS_OF)


def _feed_drops(spark, sf_dir):
    answers = feeds.answers_of(
        _state_jobs(spark, sf_dir), inputs.feed_docs(spark, sf_dir)
    )
    return feeds.entries_to_drops(feeds.entries(answers), AS_OF)


def feed_drops(spark, sf_dir):
    drops = _feed_drops(spark, sf_dir)
    return drops.select(
        "fetch_id", "identity_orig_id", "identity_username", "identity_name",
        "identity_avatar", "droplet_orig_id", "droplet_title",
        F.md5("droplet_content").alias("content_md5"),
        F.md5("droplet_raw").alias("raw_md5"), "droplet_locale",
        F.unix_seconds("droplet_date_pub").alias("date_pub"),
        F.col("links")[0]["url"].alias("link"),
    )


def since_last_fetch(spark, sf_dir):
    return _feed_drops(spark, sf_dir).groupBy("identity_orig_id").agg(
        F.count(F.lit(1)).alias("kept")
    )


def fetch_counts(spark, sf_dir):
    return feeds.fetch_counts(feeds.entries(inputs.feed_docs(spark, sf_dir)))


def fetch_answers(spark, sf_dir):
    return feeds.fetch_responses(
        feeds.answers_of(_state_jobs(spark, sf_dir), inputs.feed_docs(spark, sf_dir))
    )


def feed_routes(spark, sf_dir):
    subs = _lists_as_text(registry.subscriber_parts(_subscriptions(spark, sf_dir)))
    drops = _feed_drops(spark, sf_dir).select("identity_orig_id", "droplet_orig_id")
    stamped = feeds.stamp(
        staging.written(drops, "feed-drops"), staging.written(subs, "subscribers", staging.LISTS), dealt=True
    )
    return stamped.select(
        "identity_orig_id", "droplet_orig_id", "part",
        F.col("river_id").alias("rivers"), F.col("channel_ids").alias("channels"),
    )


def _lists_as_text(parts):
    """The lists of each URL as text, made once and not once per drop."""
    return parts.withColumns({c: csv(c) for c in ("river_ids", "channel_ids")})


def _replay(spark, sf_dir):
    messages = inputs.control_messages(spark, sf_dir)
    changes = events.subscription_changes(events.channel_changes(messages, "rss"))
    added = changes.where(F.col("op") == "add")
    jobs = schedule.replay_jobs(state(spark, sf_dir), added)
    subs = _lists_as_text(registry.subscriber_parts(_subscriptions(spark, sf_dir)))
    return feeds.serve_from_cache(jobs, inputs.cache(spark, sf_dir), subs)


def _served(served):
    return served.select(
        "id", "part", "droplet_orig_id", F.md5("droplet_raw").alias("raw_md5"),
        F.col("river_id").alias("rivers"), F.col("channel_ids").alias("channels"),
    )


def cache_serve(spark, sf_dir):
    served, _ = _replay(spark, sf_dir)
    return _served(served)


def _bucketed_cache(spark, sf_dir):
    path = f"{staging.shared_folder(spark, 'cache')}/table"
    rss.start_cache(inputs.cache(spark, sf_dir), path, 16)
    return path


def cache_serve_pruned(spark, sf_dir):
    """The same from a cache in buckets of URLs."""
    messages = inputs.control_messages(spark, sf_dir)
    changes = events.subscription_changes(events.channel_changes(messages, "rss"))
    jobs = schedule.replay_jobs(state(spark, sf_dir), changes.where(F.col("op") == "add"))
    subs = _lists_as_text(registry.subscriber_parts(_subscriptions(spark, sf_dir)))
    served, _ = rss.serve(staging.written(jobs, "replay"), _bucketed_cache(spark, sf_dir), subs)
    return _served(served)


def cache_insert_pruned(spark, sf_dir):
    """New rows into a cache in buckets of URLs, which is folded afterwards."""
    path = _bucketed_cache(spark, sf_dir)
    drops = feeds.first_of_fetch(_feed_drops(spark, sf_dir), keep=20)
    rows = staging.written(feeds.as_cache_rows(drops, feeds.hash_id()), "new-drops")
    rss.insert(rows, path, streams_jobs.Batch(0), keep=20)
    deltas.fold(spark, path)
    return deltas.read(spark, path).select("url", "id", "date_pub", "drop.droplet_title")


def cache_misses(spark, sf_dir):
    _, left = _replay(spark, sf_dir)
    return left.select("url", "use_cache")


def cache_trim(spark, sf_dir):
    kept = feeds.trim_cache(inputs.cache(spark, sf_dir), keep=20)
    return kept.select("url", "id", "date_pub", "drop.droplet_title")


def cache_insert(spark, sf_dir):
    drops = feeds.first_of_fetch(_feed_drops(spark, sf_dir), keep=20)
    rows = staging.written(feeds.as_cache_rows(drops, feeds.hash_id()), "new-drops")
    merged = feeds.update_cache(inputs.cache(spark, sf_dir), rows, keep=20)
    return merged.select("url", "id", "date_pub", "drop.droplet_title")


def cache_purge(spark, sf_dir):
    kept = feeds.purge_cache(
        inputs.cache(spark, sf_dir), _subscriptions(spark, sf_dir)
    )
    return kept.select("url", "id")


# --- media ----------------------------------------------------------------


def _html(spark, sf_dir):
    rows = scale.spread_if_few(bindings.view(spark, sf_dir, "fx_html_drops"), "id")
    return rows.withColumn("droplet_content", F.col("droplet_raw"))


def _found(spark, sf_dir):
    return media.extract_urls(_html(spark, sf_dir))


def page_links(spark, sf_dir):
    rows = _html(spark, sf_dir).select(
        "id", F.posexplode(text.tag_urls(F.col("droplet_raw"))).alias("pos", "u")
    )
    return rows.select(
        "id", F.col("pos").cast("bigint").alias("pos"), "u.tag", "u.url"
    )


def bare_urls(spark, sf_dir):
    rows = _html(spark, sf_dir).select(
        "id", F.posexplode(text.bare_urls(F.col("droplet_raw"))).alias("pos", "url")
    )
    return rows.select("id", F.col("pos").cast("bigint").alias("pos"), "url")


def url_parts(spark, sf_dir):
    url = F.col("url")
    return _found(spark, sf_dir).select("url").distinct().select(
        "url",
        urls.netloc(url).alias("host"),
        urls.url_path(url).alias("path"),
        urls.basename(url).alias("name"),
        urls.extension(url).alias("ext"),
    )


def short_urls(spark, sf_dir):
    marked = media.with_short_flag(
        _found(spark, sf_dir), "url", inputs.shorteners(spark)
    )
    return marked.where("short").select(
        "id", F.col("pos").cast("bigint").alias("pos"), "url"
    )


def _expansions(spark, sf_dir):
    redirects = bindings.view(spark, sf_dir, "fx_redirects")
    return media.expansions(inputs.shorteners(spark), redirects)


def expanded_urls(spark, sf_dir):
    return media.expand(_found(spark, sf_dir), _expansions(spark, sf_dir))


def _facts(spark, sf_dir, found):
    return media.url_facts(
        found,
        _expansions(spark, sf_dir),
        bindings.view(spark, sf_dir, "fx_image_probes"),
        media.page_photos(inputs.photo_pages(spark, sf_dir)),
    )


def link_classes(spark, sf_dir):
    return _facts(spark, sf_dir, _found(spark, sf_dir)).drop("key")


def page_photos(spark, sf_dir):
    return media.page_photos(inputs.photo_pages(spark, sf_dir))


def _enriched(spark, sf_dir):
    return enrichment.links_and_images(
        _html(spark, sf_dir),
        _expansions(spark, sf_dir),
        bindings.view(spark, sf_dir, "fx_image_probes"),
        media.page_photos(inputs.photo_pages(spark, sf_dir)),
    )


def drop_links(spark, sf_dir):
    rows = _enriched(spark, sf_dir)
    return rows.select(
        "id", csv(F.transform("links", lambda x: x["url"])).alias("links"),
        "media_complete", "source",
    )


def drop_media(spark, sf_dir):
    rows = _enriched(spark, sf_dir).select("id", F.posexplode("media").alias("pos", "m"))
    return rows.select(
        "id", F.col("pos").cast("bigint").alias("pos"), "m.url", "m.type",
        "m.droplet_image",
    )


def drop_image(spark, sf_dir):
    found = staging.written(_found(spark, sf_dir), "addresses")
    picked = media.collect(media.resolve(found, _facts(spark, sf_dir, found)))
    return picked.where("droplet_image is not null").select("id", "droplet_image")


# --- entities -------------------------------------------------------------


def _attempts(spark, sf_dir):
    return bindings.view(spark, sf_dir, "fx_entity_responses")


def entity_attempts(spark, sf_dir):
    done = entities.accept(_attempts(spark, sf_dir))
    return done.select(
        "correlation_id", F.col("body").isNotNull().alias("accepted"), "attempts"
    )


def _tagged(spark, sf_dir):
    drops = _drops(spark, sf_dir).select("id", "droplet_raw")
    return entities.attach(drops, entities.accept(_attempts(spark, sf_dir)), "id")


def drop_tags(spark, sf_dir):
    rows = _tagged(spark, sf_dir).select("id", F.explode("tags").alias("t"))
    return rows.select("id", "t.tag_type", "t.tag_name")


def drop_places(spark, sf_dir):
    rows = _tagged(spark, sf_dir).select("id", F.inline("places"))
    return rows.select(
        "id", "place_name",
        F.round(F.col("latitude") * 100).cast("bigint").alias("lat100"),
        F.round(F.col("longitude") * 100).cast("bigint").alias("lon100"),
        "place_type", F.col("source").alias("place_source"),
    )


def semantics_status(spark, sf_dir):
    return _tagged(spark, sf_dir).select(
        "id", "semantics_complete", "source",
        F.coalesce(F.size("tags"), F.lit(-1)).cast("bigint").alias("n_tags"),
    )


# --- mail -----------------------------------------------------------------


def _routed_mail(spark, sf_dir):
    return mail.with_rivers(inputs.mails(spark, sf_dir), _rivers(spark, sf_dir))


def mail_rivers(spark, sf_dir):
    return _routed_mail(spark, sf_dir).select(
        "mail_id", csv("river_id").alias("rivers")
    )


def mail_parts(spark, sf_dir):
    parsed = mail.parse(inputs.mails(spark, sf_dir))
    return parsed.select(
        "mail_id", "subject", "error", F.md5("content").alias("content_md5")
    )


def mail_drops(spark, sf_dir):
    drops = mail.to_drops(mail.parse(_routed_mail(spark, sf_dir)))
    return drops.select(
        "mail_id", "channel", csv("river_id").alias("rivers"), "identity_orig_id",
        "droplet_title", F.md5("droplet_content").alias("content_md5"),
        F.unix_seconds("droplet_date_pub").alias("date_pub"),
        F.col("media")[0]["url"].alias("media_url"),
        F.col("media")[0]["type"].alias("media_type"),
    )


def mail_comments(spark, sf_dir):
    hits = mail.with_tokens(
        inputs.mails(spark, sf_dir), bindings.view(spark, sf_dir, "fx_auth_tokens")
    )
    comments = mail.to_comments(mail.parse(hits), "http://api.example/", "KEY")
    field = lambda name: F.get_json_object("body", f"$.{name}").alias(name)
    return comments.select(
        "mail_id", "token", "type", "post_url", field("from_email"),
        field("context"), field("context_obj_id"),
        F.md5(F.get_json_object("body", "$.comment_text")).alias("text_md5"),
    )


def attachments(spark, sf_dir):
    found = mail.attachments(mail.parse(_routed_mail(spark, sf_dir)))
    return mail.attachment_store(found).select(
        "sha256", "content_type", F.decode("payload", "UTF-8").alias("payload")
    )


# --- push -----------------------------------------------------------------


def _requests(spark, sf_dir):
    return push.wanted(inputs.push_requests(spark, sf_dir), "deployment")


def push_gate(spark, sf_dir):
    return _requests(spark, sf_dir).groupBy("bucket_id").agg(
        F.count(F.lit(1)).alias("n")
    )


def push_payload(spark, sf_dir):
    return push.outbox(_requests(spark, sf_dir)).select(
        "bucket_id", "part", "post_url", "client_id", "payload", "drops_b64",
        "checksum", "body",
    )


def signatures(spark, sf_dir):
    """FN-3/4/5 on whole texts, with keys on both sides of the block size."""
    drops = _texts(spark, sf_dir)
    key = F.repeat(F.md5("droplet_orig_id"), F.col("id").cast("int") % 4 + 1)
    message = F.col("droplet_raw")
    return drops.select(
        "id",
        signing.hmac_sha256(key, message).alias("checksum"),
        F.md5(signing.base64_text(message)).alias("b64_md5"),
        text.sha256_hex(message).alias("sha256"),
    )


def push_log(spark, sf_dir):
    return push.update_log(
        bindings.view(spark, sf_dir, "fx_push_log"), _requests(spark, sf_dir), AS_OF
    )


def push_pending(spark, sf_dir):
    return push.update_pending(
        bindings.view(spark, sf_dir, "fx_push_settings"), _requests(spark, sf_dir)
    )


def pending_by_log(spark, sf_dir):
    return push.pending_by_log(push_log(spark, sf_dir))


# --- text and dates -------------------------------------------------------


def date_texts(spark, sf_dir):
    """FN-16/17: written and read back in each format."""
    rows = _drops(spark, sf_dir)
    when = F.timestamp_seconds("date_pub")
    return rows.select(
        "id",
        dates.rfc822_text(when).alias("rfc822"),
        dates.log_text(when).alias("log"),
        F.unix_seconds(dates.rfc822(dates.rfc822_text(when))).alias("from_rfc822"),
        F.unix_seconds(dates.mail_date(dates.log_text(when))).alias("from_log"),
    )


def line_breaks(spark, sf_dir):
    return _drops(spark, sf_dir).select(
        "id", F.md5(text.line_breaks(F.col("droplet_raw"))).alias("html_md5")
    )


QUERIES = [
    active_channels, url_subscribers, term_normalise, predicates,
    predicates_by_user_id, predicate_quota, quota_refused, first_writer, predicate_counts,
    registry_maps, predicate_maps, predicate_diff, registry_add, registry_delete,
    user_id_cache, control_events, registry_fold, subscription_fold,
    track_match, follow_match, match_rivers, follow_rivers,
    tweet_classes, tweet_drops, notices,
    urls_missing, urls_deleted, url_state, next_fetch, due_jobs, fetch_jobs,
    fetch_mode, latest_responses, fetch_status_upsert, fetch_flags, replay_jobs,
    feed_entries, feed_drops, since_last_fetch, fetch_counts, fetch_answers,
    feed_routes, cache_serve, cache_serve_pruned, cache_insert_pruned, cache_misses, cache_trim, cache_insert, cache_purge,
    page_links, bare_urls, url_parts, short_urls, expanded_urls, link_classes,
    page_photos, drop_links, drop_media, drop_image,
    entity_attempts, drop_tags, drop_places, semantics_status,
    mail_rivers, mail_parts, mail_drops, mail_comments, attachments,
    push_gate, push_payload, signatures, push_log, push_pending, pending_by_log,
    date_texts, line_breaks,
]
