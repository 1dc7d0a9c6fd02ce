"""Links and images of drops."""

from functools import reduce

from pyspark.sql import functions as F

from tributary.functions import text, urls
from tributary.operators import scale

#: Redirects followed, and the area an image must exceed.
MAX_HOPS = 5
MIN_AREA = 5000


def extract_urls(drops, id_column="id"):
    """FLT-14, FN-8/9/10/11: (id, pos, tag, url) in order of extraction.

    ``tag`` is ``img``, ``a`` (Q-18: compared in lower case) or ``text`` for
    addresses left once tags are stripped.  No shuffle; text stays behind.
    """
    bare = F.transform(
        text.bare_urls(F.col("droplet_raw")),
        lambda u: F.struct(F.lit("text").alias("tag"), u.alias("url")),
    )
    found = F.concat(text.tag_urls(F.col("droplet_raw")), bare)
    return (
        drops.where(text.filled(F.col("droplet_content")))
        .select(F.col(id_column).alias("id"), F.posexplode(found).alias("pos", "u"))
        .select("id", "pos", "u.tag", "u.url")
    )


def _key():
    """An address as an image tag shows it and as a link are two things."""
    shown = F.when(F.col("tag") == "img", "img ").otherwise("link ")
    return F.concat(shown, F.col("url"))


def with_short_flag(df, url_column, shorteners):
    """JOIN-12: ``short`` tells whether the host is a listed short domain."""
    known = scale.broadcast_if_small(
        shorteners.select(F.col("domain").alias("_domain")).distinct().withColumn(
            "short", F.lit(True)
        )
    )
    marked = df.withColumn("_domain", urls.domain(F.col(url_column)))
    return (
        marked.join(known, "_domain", "left")
        .withColumn("short", F.coalesce("short", F.lit(False)))
        .drop("_domain")
    )


def redirect_steps(redirects, shorteners):
    """SRC-17, FLT-18: (url, next, live) of the captured redirects that lead on.

    Only answers 100-399 with a location count, and only from short domains;
    ``live`` tells that the target is short itself, so has a further step.
    """
    usable = redirects.where(
        F.col("status").between(100, 399) & F.col("location").isNotNull()
    )
    # Of several captures of an address the smallest usable answer counts.
    usable = usable.groupBy("url").agg(
        F.min(F.struct("status", "location"))["location"].alias("next")
    )
    from_short = (
        with_short_flag(usable, "url", shorteners).where(F.col("short")).drop("short")
    )
    return with_short_flag(from_short, "next", shorteners).withColumnRenamed(
        "short", "live"
    )


def expansions(shorteners, redirects, hops=MAX_HOPS):
    """JOIN-13: (url, full_url) of every captured short address.

    What follows ``n + 1`` hops from an address is what follows ``n`` from its
    target: ``hops`` rounds, unrolled, each joining the captures (never a
    derived table) to the round before.  A failed or missing capture leaves the
    address as it stands.  A target that very many addresses share is spread;
    settled rows get a join key of their own that matches nothing.  The result
    can be stored and shared.
    """
    steps = redirect_steps(redirects, shorteners)
    # Every round has the rows of ``steps``, so one measurement serves all.
    small = scale.is_small(steps)
    onward = F.when(F.col("live"), F.col("next")).otherwise(
        F.concat(F.lit(" "), F.col("url"))
    )
    keyed = steps.withColumn("_at", onward)

    def one_hop_more(known, _):
        further = known.select(
            F.col("url").alias("_at"), F.col("full_url").alias("_further")
        )
        joined = scale.skew_join(
            keyed, further, "_at", "left", spread_by=["url"], small=small
        )
        return joined.select("url", F.coalesce("_further", "next").alias("full_url"))

    first = steps.select("url", F.col("next").alias("full_url"))
    return reduce(one_hop_more, range(hops - 1), first)


def expand(found, expanded):
    """JOIN-13: (url, full_url) of the distinct addresses in ``found`` that are
    expanded, i.e. of all but those of image tags."""
    distinct = found.where(F.col("tag") != "img").select("url").distinct()
    return distinct.join(expanded, "url", "left").select(
        "url", F.coalesce("full_url", "url").alias("full_url")
    )


def page_photos(pages):
    """SRC-19, FN-15: (url, photo) of captured photo pages that show one, one row
    per page however often it was captured."""
    shown = pages.select(
        "url", urls.page_photo(F.col("url"), F.col("html")).alias("photo")
    ).where(F.col("photo").isNotNull())
    return shown.groupBy("url").agg(F.min("photo").alias("photo"))


def classify(expanded, photos=None):
    """FN-13/14, FLT-11: ``kind`` image or link, and the address it stands for.

    Works on (url, full_url, …), expansion first (Q-25).  Only addresses of
    photo pages take part in the join on ``photos`` (url, photo).
    """
    full = F.col("full_url")
    if photos is None:
        known = expanded.withColumn("_photo", F.lit(None).cast("string"))
    else:
        captured = photos.select(
            F.col("url").alias("_page"), F.col("photo").alias("_photo")
        )
        page = F.when(urls.has_photo_page(full), full).otherwise(
            F.concat(F.lit(" "), F.col("url"))
        )
        known = expanded.withColumn("_page", page).join(captured, "_page", "left")
    picture = F.when(urls.is_image(full), full).otherwise(
        F.coalesce(urls.photo_address(full), F.col("_photo"))
    )
    return known.select(
        *expanded.columns,
        F.when(picture.isNotNull(), "image").otherwise("link").alias("kind"),
        F.coalesce(picture, full).alias("target"),
    )


def url_facts(found, expanded, probes, photos=None):
    """All that is known of each distinct address: expansion, kind, image size.

    Looked up once per distinct (tag is img, url), so that a link in a third of
    all drops is expanded, classified and probed once.  ``expanded`` comes from
    ``expansions``.  SRC-18, FN-11, JOIN-15.
    """
    img = F.col("img")
    distinct = found.select(
        _key().alias("key"), (F.col("tag") == "img").alias("img"), "url"
    ).distinct()
    full = distinct.join(expanded, "url", "left").select(
        "key",
        "img",
        "url",
        F.when(img, F.col("url"))
        .otherwise(F.coalesce("full_url", "url"))
        .alias("full_url"),
    )
    classed = classify(full, photos).select(
        "key",
        "img",
        "url",
        "full_url",
        F.when(img, "image").otherwise(F.col("kind")).alias("kind"),
        F.when(img, F.col("url")).otherwise(F.col("target")).alias("target"),
    )
    area = F.col("width").cast("bigint") * F.col("height")
    sizes = probes.groupBy(F.col("url").alias("_probe")).agg(F.max(area).alias("area"))
    probed = F.when(F.col("kind") == "image", F.col("target")).otherwise(
        F.concat(F.lit(" "), F.col("url"))
    )
    return (
        classed.withColumn("_probe", probed)
        .join(sizes, "_probe", "left")
        .drop("_probe")
    )


def resolve(found, facts):
    """(id, pos, kind, target, area) of every mention, by one join in which an
    address of very many mentions is spread.  ``found`` should be stored."""
    mentions = found.select("id", "pos", _key().alias("key"))
    looked_up = facts.select("key", "kind", "target", "area")
    return scale.skew_join(
        mentions, looked_up, "key", spread_by=["id", "pos"]
    ).select("id", "pos", "kind", "target", "area")


def collect(mentions, min_area=MIN_AREA):
    """AGG-6/9, FLT-12, PRJ-9: links and media of each drop (id, links, media).

    Images without a probe or too small go; the largest is the drop's image,
    the first of equals, and every copy of it is flagged (Q-19).  A group is
    the addresses of one text.  Empty lists stay NULL.
    """
    big = (F.col("kind") == "image") & (F.col("area") > min_area)
    link = F.when(
        F.col("kind") == "link", F.struct("pos", F.col("target").alias("url"))
    )
    image = F.when(big, F.struct("pos", F.col("target").alias("url")))
    best = F.max_by("target", F.when(big, F.struct("area", -F.col("pos"))))
    grouped = mentions.groupBy("id").agg(
        F.array_sort(F.collect_list(link)).alias("_links"),
        F.array_sort(F.collect_list(image)).alias("_images"),
        best.alias("droplet_image"),
    )
    links = F.transform("_links", lambda x: F.struct(x["url"].alias("url")))
    media = F.transform(
        "_images",
        lambda x: F.struct(
            x["url"].alias("url"),
            F.lit("image").alias("type"),
            (x["url"] == F.col("droplet_image")).alias("droplet_image"),
        ),
    )
    return grouped.select(
        "id",
        F.when(F.size("_links") > 0, links).alias("links"),
        F.when(F.size("_images") > 0, media).alias("media"),
        "droplet_image",
    )


def attach(drops, enrichment, merge_links=False, id_column="id"):
    """PRJ-8/9 (Q-17): drops with links and media, all stamped as complete.

    Found links are taken only by a drop that has none, unless ``merge_links``
    adds those whose address it lacks.
    """
    plus = enrichment.select(
        F.col("id").alias(id_column),
        F.transform(
            "links",
            lambda x: F.struct(
                x["url"].alias("url"),
                F.lit(None).cast("boolean").alias("original_url"),
            ),
        ).alias("_links"),
        F.col("media").alias("_media"),
    )
    joined = drops.join(plus, id_column, "left")
    has_links = "links" in drops.columns
    own = F.col("links") if has_links else F.lit(None)
    if merge_links and has_links:
        taken = F.transform(own, lambda x: x["url"])
        extra = F.filter("_links", lambda x: ~F.array_contains(taken, x["url"]))
        links = F.coalesce(F.concat(own, extra), own, F.col("_links"))
    else:
        links = F.coalesce(own, F.col("_links")) if has_links else F.col("_links")
    media = (
        F.coalesce(F.col("_media"), F.col("media"))
        if "media" in drops.columns
        else F.col("_media")
    )
    return joined.withColumns(
        {
            "links": links,
            "media": media,
            "media_complete": F.lit(True),
            "source": F.lit("mediaextractor"),
        }
    ).drop("_links", "_media")
