"""Fetch state of feed URLs: what to add, drop, fetch and update."""

from pyspark.sql import functions as F

from tributary.functions import text

#: Fixed value: seconds between two fetches, and the widest extra delay.
FETCH_INTERVAL = 1800

STATE_COLUMNS = [
    "url",
    "last_fetch_time",
    "last_fetch_etag",
    "last_fetch_modified",
    "next_fetch_time",
    "submitted",
]


def next_fetch_time(url, last_fetch_time, interval=FETCH_INTERVAL):
    """FN-19: last + interval + an extra delay of 0..interval seconds.

    The delay is a hash of URL and time, so that a recomputed task agrees.
    """
    digest = F.md5(F.concat(url, last_fetch_time.cast("string")))
    delay = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % (interval + 1)
    return last_fetch_time + F.lit(interval) + delay


def load_state(rss_urls, interval=FETCH_INTERVAL):
    """SRC-3: stored fetch state, a missing time counting as 0."""
    last = F.coalesce("last_fetch_time", F.lit(0).cast("bigint"))
    return rss_urls.select(
        "url",
        last.alias("last_fetch_time"),
        "last_fetch_etag",
        "last_fetch_modified",
        next_fetch_time(F.col("url"), last, interval).alias("next_fetch_time"),
        F.lit(False).alias("submitted"),
    )


def reconcile(url_state, subscribed):
    """JOIN-2/3/4, SET-1, SNK-6: state against subscriptions in one join.

    Returns the state columns, ``url_hash`` and ``change``: ``new`` for a URL
    without state (due at once), ``orphan`` for one nobody subscribes to any
    more, else ``kept``.  Both sides hold a URL once, so no key is hot.
    """
    wanted = subscribed.select("url").distinct().withColumn("_wanted", F.lit(True))
    known = url_state.select(*STATE_COLUMNS, F.lit(True).alias("_known"))
    zero = F.lit(0).cast("bigint")
    change = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_wanted").isNull(), "orphan")
        .otherwise("kept")
    )
    return known.join(wanted, "url", "full").select(
        "url",
        F.coalesce("last_fetch_time", zero).alias("last_fetch_time"),
        "last_fetch_etag",
        "last_fetch_modified",
        F.coalesce("next_fetch_time", zero).alias("next_fetch_time"),
        F.coalesce("submitted", F.lit(False)).alias("submitted"),
        F.md5("url").alias("url_hash"),
        change.alias("change"),
    )


def missing_urls(reconciled):
    """JOIN-2: rows to insert."""
    return reconciled.where(F.col("change") == "new").select("url", "url_hash")


def orphan_urls(reconciled):
    """JOIN-3: rows to delete, by hash."""
    return reconciled.where(F.col("change") == "orphan").select("url", "url_hash")


def current_state(reconciled):
    """JOIN-4: the state that goes on."""
    return reconciled.where(F.col("change") != "orphan").drop("change", "url_hash")


def fetch_mode():
    """FLT-4 (Q-27): by etag, else by modification date, else the full feed."""
    return (
        F.when(text.filled(F.col("last_fetch_etag")), "etag")
        .when(text.filled(F.col("last_fetch_modified")), "modified")
        .otherwise("full")
    )


def due_jobs(url_state, as_of):
    """FLT-2, FLT-4, PRJ-5, FN-7: fetch jobs of the URLs due at ``as_of``."""
    due = ~F.col("submitted") & (F.lit(as_of) > F.col("next_fetch_time"))
    return url_state.where(due).select(
        "url",
        text.plain_ampersands(F.col("url")).alias("fetch_url"),
        "next_fetch_time",
        "last_fetch_time",
        "last_fetch_etag",
        "last_fetch_modified",
        F.lit(False).alias("use_cache"),
        fetch_mode().alias("mode"),
    )


def in_order(jobs):
    """SORT-1: a range-partitioned sort, for output only."""
    return jobs.orderBy("next_fetch_time", "url")


def with_subscribers(jobs, subscriber_parts):
    """PRJ-5: job messages with the arrays of rivers and channels."""
    return jobs.join(subscriber_parts, "url")


def replay_jobs(url_state, added):
    """STR-10, PRJ-5: a job served from the cache for each added subscription's
    URL, whether or not that URL is due."""
    urls = added.select("url").distinct()
    return urls.join(url_state, "url", "left").select(
        "url",
        text.plain_ampersands(F.col("url")).alias("fetch_url"),
        F.coalesce("next_fetch_time", F.lit(0).cast("bigint")).alias("next_fetch_time"),
        F.coalesce("last_fetch_time", F.lit(0).cast("bigint")).alias("last_fetch_time"),
        "last_fetch_etag",
        "last_fetch_modified",
        F.lit(True).alias("use_cache"),
        fetch_mode().alias("mode"),
    )


def mark_submitted(url_state, jobs):
    """STR-6: flag the URLs a job went out for."""
    sent = jobs.select("url").distinct().withColumn("_sent", F.lit(True))
    return url_state.join(sent, "url", "left").select(
        *[c for c in STATE_COLUMNS if c != "submitted"],
        (F.col("submitted") | F.col("_sent").isNotNull()).alias("submitted"),
    )


def latest_responses(responses):
    """AGG-12: the last response of each URL, combined before the shuffle."""
    fields = F.struct(
        "status", "last_fetch_time", "last_fetch_etag", "last_fetch_modified"
    )
    return (
        responses.groupBy("url")
        .agg(F.max_by(fields, "seq").alias("r"))
        .select("url", "r.*")
    )


def apply_responses(url_state, responses, interval=FETCH_INTERVAL):
    """SNK-6, STR-6 (Q-5: a URL without state gets one): the state after it."""
    last = latest_responses(responses).select(
        "url",
        F.col("last_fetch_time").alias("_time"),
        F.col("last_fetch_etag").alias("_etag"),
        F.col("last_fetch_modified").alias("_modified"),
        F.lit(True).alias("_answered"),
    )
    answered = F.col("_answered").isNotNull()
    upcoming = next_fetch_time(F.col("url"), F.col("_time"), interval)

    def updated(new, old):
        return F.when(answered, F.col(new)).otherwise(F.col(old)).alias(old)

    return url_state.join(last, "url", "full").select(
        "url",
        updated("_time", "last_fetch_time"),
        updated("_etag", "last_fetch_etag"),
        updated("_modified", "last_fetch_modified"),
        F.when(answered, upcoming)
        .otherwise(F.col("next_fetch_time"))
        .alias("next_fetch_time"),
        F.when(answered, F.lit(False))
        .otherwise(F.col("submitted"))
        .alias("submitted"),
    )
