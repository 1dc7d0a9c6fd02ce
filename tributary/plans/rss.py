"""From subscriptions to fetch jobs, and from captured answers to drops."""

from tributary.operators import feeds, registry, schedule
from tributary.sources import deltas, staging


def fetch_jobs(rss_urls, active, as_of):
    """Job messages of the URLs due at ``as_of``, with their subscribers.

    Subscriptions are aggregated once; the URL-level tables are joined on the
    URL, each side holding it once.
    """
    parts = registry.url_subscribers(active)
    state = schedule.reconcile(schedule.load_state(rss_urls), parts)
    jobs = schedule.due_jobs(schedule.current_state(state), as_of)
    return schedule.with_subscribers(jobs, parts)


def refresh(url_state, active, feed_docs, cache, as_of, keep=feeds.KEEP):
    """One round of fetching: (drops, responses, url_state, cache).

    Documents are parsed once and stored; their drops are stored before routing and
    cache read them.  A URL that answered with no feed is not answered: its state
    stays as it was, so it is due again in the next round.  Cache rows take their ids from the drop's own hash, so that a
    repeated round writes the same rows.
    """
    parts = registry.url_subscribers(active)
    state = schedule.current_state(schedule.reconcile(url_state, parts))
    jobs = schedule.due_jobs(state, as_of)
    read = staging.written(feeds.parsed(feeds.answers_of(jobs, feed_docs)), "feeds")
    found = staging.written(
        feeds.entries_to_drops(feeds.entries_of(read), as_of), "feed-drops"
    )
    drops = feeds.stamp(found, parts)
    responses = feeds.fetch_responses(feeds.answered(read))
    broken = feeds.quarantined_of(read).select("url").distinct()
    after = schedule.apply_responses(
        schedule.mark_submitted(state, jobs.join(broken, "url", "left_anti")),
        responses.withColumnRenamed("fetch_id", "seq"),
    )
    rows = feeds.as_cache_rows(feeds.first_of_fetch(found, keep), feeds.hash_id())
    return drops, responses, after, feeds.update_cache(cache, rows, keep)


def start_cache(cache, path, buckets=deltas.BUCKETS):
    """SRC-4: the cache of drops as a table in buckets of URLs."""
    deltas.start(cache, path, ["url", "id"], buckets)


def serve(jobs, path, parts):
    """JOIN-5/6: (drops served, jobs left) from a bucketed cache, of which only the
    buckets of the URLs asked for are opened; ``jobs`` should be stored."""
    spark = jobs.sparkSession
    asked = jobs.where("use_cache").select("url").distinct()
    buckets = deltas.touched_buckets(spark, path, asked)
    return feeds.serve_from_cache(jobs, deltas.read(spark, path, buckets), parts)


def insert(rows, path, batch, keep=feeds.KEEP):
    """SNK-7: new cache rows (stored) into a bucketed cache; what is written are the
    new rows and those that they displace."""
    spark = rows.sparkSession
    buckets = deltas.touched_buckets(spark, path, rows)
    before = deltas.read(spark, path, buckets, before=deltas.position(spark, path, batch))
    deltas.append(feeds.cache_changes(before, rows, keep), path, batch)
