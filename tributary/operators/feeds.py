"""Captured feed documents to drops, and the cache of recent drops per URL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tributary import schemas
from tributary.functions import dates, text
from tributary.operators import scale

#: Fixed value: drops kept per URL, and drops inserted per fetch.
KEEP = 50

_XML = {"ignoreSurroundingSpaces": "false"}


def answers_of(jobs, feed_docs):
    """The captured answers to jobs, with the columns of the job.

    Joined before any document is parsed: answers nobody asked for cost no
    parsing, and a URL with very many answers is spread.
    """
    asked = jobs.select(
        "url", "last_fetch_time", "last_fetch_etag", "last_fetch_modified"
    )
    return scale.skew_join(feed_docs, asked, "url", spread_by=["fetch_id"])


def _trees(doc):
    """The document as a tree of its dialect: rss, rdf or atom, the others NULL.

    A document that is cut off, or none of these, has no tree.
    """
    # A byte-order mark is no part of the document.
    doc = F.when(doc.startswith("\ufeff"), F.substring(doc, F.lit(2), F.char_length(doc))).otherwise(doc)
    prolog = r"(?s)^\s*(<\?xml[^>]*\?>\s*)?(<!DOCTYPE[^>]*>\s*)?(<!--.*?-->\s*)*"
    atom, rdf = doc.rlike(rf"{prolog}<feed\b"), doc.rlike(rf"{prolog}<rdf:RDF\b")
    whole = doc.rlike(r"(?s)</(rss|feed|rdf:RDF)>\s*(<!--.*?-->\s*)*$")

    def tree(schema, tag):
        return F.from_xml(doc, schema, {**_XML, "rowTag": tag})

    return {
        "r": F.when(whole & ~atom & ~rdf, tree(schemas.RSS_FEED, "rss")["channel"]),
        "d": F.when(whole & rdf, tree(schemas.RDF_FEED, "rdf:RDF")),
        "f": F.when(whole & atom, tree(schemas.ATOM_FEED, "feed")),
    }


def parsed(feed_docs):
    """Captured answers with their trees and ``readable``: each document parsed once.

    Store the result if several outputs are made of it.  An answer without a
    document (not modified) is readable; one that is no feed, or only a part of one,
    is not: it must not count as answered.
    """
    trees = feed_docs.withColumns(_trees(F.col("doc")))
    # Trees of nothing but nulls are what other XML gives.
    tree = F.coalesce("r.title", "r.link", F.to_json("r"), F.to_json("d"), F.to_json("f"))
    broken = F.col("doc").isNotNull() & (tree.isNull() | tree.isin("{}", ""))
    return trees.withColumn("readable", ~broken)


def answered(read):
    """STR-14: of ``parsed`` answers those that count, without their trees."""
    return read.where("readable").drop("r", "d", "f", "readable")


def quarantined_of(read):
    """STR-14: of ``parsed`` answers those that are no feed, as they came."""
    return read.where(~F.col("readable")).drop("r", "d", "f", "readable")


def quarantined(feed_docs):
    """STR-14: captured documents that are no feed, or only a part of one."""
    return quarantined_of(parsed(feed_docs))


def entries(feed_docs):
    """SRC-5: entries of captured feeds with their place in the feed.

    ``feed_docs`` is (url, fetch_id, doc, …) with one captured answer per row;
    its other columns are kept.  Both dialects end in the same columns; ``pos``
    counts from 0.  Each document is parsed once, by its own dialect; the outer
    explode keeps Spark from testing the list in a filter that parses it again.
    """
    trees = feed_docs.where(F.col("doc").isNotNull()).withColumns(_trees(F.col("doc")))
    return entries_of(trees)


def entries_of(trees):
    """SRC-5: the entries of ``parsed`` answers."""
    kept = [c for c in trees.columns if c not in ("doc", "r", "d", "f", "readable")]
    rdf_items = F.transform(
        "d.item",
        lambda e: F.struct(
            e["_rdf:about"].alias("entry_id"),
            e["link"].alias("link"),
            e["title"].alias("title"),
            e["description"].alias("summary"),
            e["content:encoded"].alias("content"),
            e["dc:date"].alias("date"),
        ),
    )
    rss_items = F.transform(
        "r.item",
        lambda e: F.struct(
            e["guid"].alias("entry_id"),
            e["link"].alias("link"),
            e["title"].alias("title"),
            e["description"].alias("summary"),
            e["content:encoded"].alias("content"),
            e["pubDate"].alias("date"),
        ),
    )
    atom_items = F.transform(
        "f.entry",
        lambda e: F.struct(
            e["id"].alias("entry_id"),
            _page_link(e["link"]).alias("link"),
            e["title"].alias("title"),
            e["summary"].alias("summary"),
            e["content"].alias("content"),
            F.coalesce(e["published"], e["updated"]).alias("date"),
        ),
    )
    listed = trees.select(
        *kept,
        F.coalesce("r.title", "d.channel.title", "f.title").alias("feed_title"),
        F.coalesce("r.link", "d.channel.link", _page_link(F.col("f.link"))).alias("feed_link"),
        F.coalesce("r.language", "d.channel.`dc:language`", "f.`_xml:lang`").alias(
            "feed_language"
        ),
        F.coalesce("r.image.url", "d.image.url", "f.logo").alias("feed_image"),
        (F.col("f").isNotNull() | F.col("d").isNotNull()).alias("_iso"),
        F.posexplode_outer(F.coalesce(rss_items, rdf_items, atom_items)).alias("pos", "e"),
    )
    date = F.when(F.col("_iso"), dates.iso8601(F.col("date"))).otherwise(
        dates.rfc822(F.col("date"))
    )
    return (
        listed.where(F.col("pos").isNotNull())
        .select("*", "e.*")
        .withColumn("date_parsed", date)
        .drop("e", "date", "_iso")
    )


def _page_link(links):
    pages = F.filter(
        links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"
    )
    return F.try_element_at(pages, F.lit(1))["_href"]


def fetch_counts(feed_entries):
    """AGG-11: entries per fetch, counted before any is skipped."""
    return feed_entries.groupBy("url", "fetch_id").agg(
        F.count(F.lit(1)).alias("drop_count")
    )


def entries_to_drops(feed_entries, as_of):
    """PRJ-1/2, FLT-3: drops of the entries of answered jobs (``answers_of``).

    Rivers and channels are stamped by ``stamp`` from the job's subscribers, so
    that the text of an entry is not repeated before it must be.
    """
    date = F.coalesce("date_parsed", dates.instant(as_of))
    conditional = text.filled(F.col("last_fetch_etag")) | text.filled(
        F.col("last_fetch_modified")
    )
    fresh = conditional | (F.unix_seconds(date) >= F.col("last_fetch_time"))
    content = F.coalesce("content", "summary")
    link = F.struct(F.col("link").alias("url"), F.lit(True).alias("original_url"))
    return feed_entries.where(fresh).select(
        "fetch_id",
        "pos",
        F.lit("rss").alias("channel"),
        F.col("url").alias("identity_orig_id"),
        F.coalesce("feed_link", "url").alias("identity_username"),
        F.coalesce("feed_title", "url").alias("identity_name"),
        F.col("feed_image").alias("identity_avatar"),
        text.md5_text(F.col("link"), F.col("entry_id")).alias("droplet_orig_id"),
        F.lit("original").alias("droplet_type"),
        F.col("title").alias("droplet_title"),
        content.alias("droplet_content"),
        content.alias("droplet_raw"),
        F.col("feed_language").alias("droplet_locale"),
        date.alias("droplet_date_pub"),
        F.when(F.col("link").isNotNull(), F.array(link)).alias("links"),
    )


def stamp(drops, subscriber_parts, dealt=False):
    """PRJ-7: give each drop the rivers and channels of its URL.

    A URL whose subscribers fill several parts yields the drop once per part.
    ``drops`` should be stored if there are very many subscribers.  ``dealt`` deals
    stored drops of few columns by their lists, which may also be given as text.
    """
    targets = subscriber_parts.select(
        F.col("url").alias("identity_orig_id"),
        "part",
        F.col("river_ids").alias("river_id"),
        "channel_ids",
    )
    plain = drops.drop("river_id", "channel_ids")
    join = scale.dealt_lists if dealt else scale.skew_join
    return join(plain, targets, "identity_orig_id", spread_by=["droplet_orig_id"])


def fetch_responses(answers):
    """PRJ-6, SNK-4: status rows; etag and date fall back to the job's own."""
    return answers.select(
        "url",
        "fetch_id",
        "status",
        F.coalesce("modified", "last_fetch_modified").alias("last_fetch_modified"),
        F.coalesce("etag", "last_fetch_etag").alias("last_fetch_etag"),
        F.col("fetched_at").alias("last_fetch_time"),
    )


def split_jobs(jobs, cache):
    """JOIN-5: jobs with ``from_cache``: asked for and at least one row cached.

    The cached URLs are made distinct before the shuffle, whatever a hot URL's
    number of rows.
    """
    cached = cache.select("url").distinct().withColumn("_cached", F.lit(True))
    return jobs.join(cached, "url", "left").select(
        *jobs.columns,
        (F.col("use_cache") & F.col("_cached").isNotNull()).alias("from_cache"),
    )


def serve_from_cache(jobs, cache, subscriber_parts):
    """JOIN-5/6, PRJ-7: (stamped drops of the jobs the cache serves, other jobs).

    ``cache`` is (id, url, date_pub, drop); a hot URL of it is spread.  Drops of a URL
    share its lists and come out together if these are long; lists may also be given
    as text.
    """
    asked = jobs.where(F.col("use_cache")).select("url").distinct()
    targets = asked.join(subscriber_parts, "url").select(
        "url", "part", F.col("river_ids").alias("_rivers"), "channel_ids"
    )
    served = scale.beside_lists(cache, targets, "url", spread_by=["id"])
    restamped = F.col("drop").dropFields("river_id", "channel_ids")
    served = served.select(
        "id", "part", restamped.alias("drop"), "_rivers", "channel_ids"
    ).select(
        "id", "part", "drop.*", F.col("_rivers").alias("river_id"), "channel_ids"
    )
    left = split_jobs(jobs, cache).where(~F.col("from_cache")).drop("from_cache")
    return served, left


def trim_cache(cache, keep=KEEP):
    """WIN-1, SORT-2: the newest ``keep`` rows of each URL.

    The literal bound lets Spark cut each map task's rows to ``keep`` per URL
    before the shuffle, so a hot URL does not fill one task.
    """
    newest = Window.partitionBy("url").orderBy(F.desc("date_pub"), F.desc("id"))
    ranked = cache.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= keep).drop("_rank")


def first_of_fetch(drops, keep=KEEP):
    """WIN-2: at most the first ``keep`` drops of a fetch, in feed order."""
    order = Window.partitionBy("identity_orig_id", "fetch_id").orderBy("pos")
    ranked = drops.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= keep).drop("_rank")


def hash_id():
    """A row id from the drop's own hash, the same on every run."""
    return F.conv(F.substring("droplet_orig_id", 1, 12), 16, 10).cast("bigint")


def as_cache_rows(drops, row_id):
    """A drop in the shape of a cache row; ``row_id`` is its id expression."""
    packed = [c for c in drops.columns if c in schemas.DROP_COLUMNS]
    return drops.select(
        row_id.alias("id"),
        F.col("identity_orig_id").alias("url"),
        F.unix_seconds("droplet_date_pub").alias("date_pub"),
        F.struct(*packed).alias("drop"),
    )


def update_cache(cache, new_rows, keep=KEEP):
    """SNK-7: only URLs that got new drops are trimmed, and before the insert,
    so that twice ``keep`` rows may stay until the next time.

    With a list of touched URLs that is small, as after one round of fetches,
    rows of other URLs pass as they are read, neither shuffled nor sorted.
    """
    touched = scale.broadcast_if_small(new_rows.select("url").distinct())
    untouched = cache.join(touched, "url", "left_anti")
    kept = trim_cache(cache.join(touched, "url", "left_semi"), keep)
    return (
        untouched.select(*cache.columns)
        .unionByName(kept.select(*cache.columns))
        .unionByName(new_rows.select(*cache.columns), allowMissingColumns=True)
    )


def cache_changes(cache, new_rows, keep=KEEP):
    """SNK-7, WIN-1: what ``update_cache`` changes, as rows of ``cache`` with ``deleted``.

    ``cache`` need only hold the URLs of ``new_rows``.  A drop that is fetched again
    replaces its row; of several new rows with one id the newest stays.
    """
    touched = scale.broadcast_if_small(new_rows.select("url").distinct())
    before = cache.join(touched, "url", "left_semi").select(*cache.columns)
    gone = before.join(trim_cache(before, keep).select("url", "id"), ["url", "id"], "left_anti")
    gone = gone.join(new_rows.select("url", "id"), ["url", "id"], "left_anti")
    known = {f.name for f in new_rows.schema["drop"].dataType.fields}
    drop = [
        (F.col("drop")[f.name] if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in cache.schema["drop"].dataType.fields
    ]
    newest = F.max_by(F.struct("date_pub", "drop"), F.struct("date_pub", F.to_json("drop")))
    once = new_rows.groupBy("url", "id").agg(newest.alias("n")).select("url", "id", "n.*")
    added = once.withColumn("drop", F.struct(*drop))
    added = added.select(*cache.columns, F.lit(False).alias("deleted"))
    return added.unionByName(gone.select(*cache.columns, F.lit(True).alias("deleted")))


def purge_cache(cache, subscribed):
    """Q-6, optional: rows of URLs that somebody still subscribes to."""
    return cache.join(subscribed.select("url").distinct(), "url", "left_semi")
