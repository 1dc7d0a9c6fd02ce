"""The views of ``bindings`` in the form the operators read: JSON, XML, MIME."""

from pyspark.sql import functions as F

from tributary.checks import bindings
from tributary.functions import dates
from tributary.operators import scale


def _view(spark, sf_dir, name):
    return bindings.view(spark, sf_dir, name)


def _escaped(text):
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def _element(name, column, attributes=""):
    return F.when(
        column.isNotNull(),
        F.concat(
            F.lit(f"<{name}{attributes}>"), _escaped(column), F.lit(f"</{name}>")
        ),
    ).otherwise("")


def feed_docs(spark, sf_dir):
    """One captured document per fetch, in two dialects.

    An entry range makes a fetch, so a document has at most 1,000 entries.
    """
    rows = _view(spark, sf_dir, "fx_entries")
    when = F.timestamp_seconds("published")
    item = F.concat(
        F.lit("<item>"),
        _element("guid", F.col("entry_id")),
        _element("link", F.col("link")),
        _element("title", F.col("title")),
        _element("description", F.col("summary")),
        _element("content:encoded", F.col("content")),
        _element("pubDate", dates.rfc822_text(when)),
        F.lit("</item>"),
    )
    link = F.when(
        F.col("link").isNotNull(),
        F.concat(
            F.lit('<link rel="self" href="http://no.example/"/><link href="'),
            _escaped(F.col("link")),
            F.lit('"/>'),
        ),
    ).otherwise("")
    iso = F.concat(F.replace(dates.log_text(when), F.lit(" "), F.lit("T")), F.lit("Z"))
    entry = F.concat(
        F.lit("<entry>"),
        _element("id", F.col("entry_id")),
        link,
        _element("title", F.col("title")),
        _element("summary", F.col("summary"), ' type="text"'),
        _element("content", F.col("content"), ' type="html"'),
        _element("updated", iso),
        F.lit("</entry>"),
    )
    atom = F.col("dialect") == "atom"
    packed = rows.groupBy(
        "url",
        "fetch_id",
        "dialect",
        "feed_title",
        "feed_link",
        "feed_language",
        "feed_image",
    ).agg(
        F.array_sort(
            F.collect_list(
                F.struct("doc_id", F.when(atom, entry).otherwise(item).alias("x"))
            )
        ).alias("items"),
        F.min("doc_id").alias("first"),
    )
    body = F.array_join(F.transform("items", lambda i: i["x"]), "\n")
    image = F.when(
        F.col("feed_image").isNotNull(),
        F.concat(F.lit("<image><url>"), F.col("feed_image"), F.lit("</url></image>")),
    ).otherwise("")
    rss_doc = F.concat(
        F.lit(
            '<?xml version="1.0"?>\n<rss version="2.0" '
            'xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>'
        ),
        _element("title", F.col("feed_title")),
        _element("link", F.col("feed_link")),
        _element("language", F.col("feed_language")),
        image,
        body,
        F.lit("</channel></rss>"),
    )
    atom_doc = F.concat(
        F.lit('<?xml version="1.0"?>\n<feed xmlns="http://www.w3.org/2005/Atom" '),
        F.concat(F.lit('xml:lang="'), F.col("feed_language"), F.lit('">')),
        _element("title", F.col("feed_title")),
        F.concat(F.lit('<link href="'), F.col("feed_link"), F.lit('"/>')),
        _element("logo", F.col("feed_image")),
        body,
        F.lit("</feed>"),
    )
    return packed.select(
        "url",
        "fetch_id",
        F.when(atom, atom_doc).otherwise(rss_doc).alias("doc"),
        F.when(F.col("first") % 2 == 0, 200).otherwise(304).alias("status"),
        F.when(
            F.col("first") % 4 == 0, F.concat(F.lit("new-"), F.col("feed_title"))
        ).alias("etag"),
        F.when(F.col("first") % 4 == 1, F.lit("Tue, 02 Jan 2024 00:00:00 GMT")).alias(
            "modified"
        ),
        F.lit(bindings.AS_OF).cast("bigint").alias("fetched_at"),
    )


def cache(spark, sf_dir):
    """Cached drops: (id, url, date_pub, drop)."""
    rows = _view(spark, sf_dir, "fx_drops")
    drop = F.struct(
        F.lit("rss").alias("channel"),
        F.array(F.lit(-1).cast("bigint")).alias("river_id"),
        F.array(F.lit(-1).cast("bigint")).alias("channel_ids"),
        "identity_orig_id",
        "droplet_orig_id",
        "droplet_title",
        "droplet_content",
        "droplet_raw",
    )
    return rows.select(
        "id",
        F.concat(F.lit(bindings.FEEDS), F.col("identity_orig_id")).alias("url"),
        "date_pub",
        drop.alias("drop"),
    )


def tweet_lines(spark, sf_dir):
    """The stream as text, one message per line, some of it broken."""
    return tweet_text(_view(spark, sf_dir, "fx_tweets"))


def tweet_text(rows):
    """Rows of ``fx_tweets`` as lines."""
    id_text = F.col("id").cast("string")
    when = F.to_utc_timestamp(
        F.timestamp_seconds(F.col("id") + 1704067200), F.current_timezone()
    )
    created = F.date_format(when, "EEE MMM dd HH:mm:ss '+0000' yyyy")
    user = F.struct(
        F.concat(F.lit("u"), (F.col("conv_id") % 50).cast("string")).alias("id_str"),
        "screen_name",
        F.concat(F.lit("Name of "), F.col("screen_name")).alias("name"),
        F.lit("http://img.example/avatar.png").alias("profile_image_url"),
        F.lit("en").alias("lang"),
    )
    status = F.struct(
        "text",
        id_text.alias("id_str"),
        created.alias("created_at"),
        F.lit(None).cast("bigint").alias("in_reply_to_status_id"),
        F.when(
            F.col("turn") > 0,
            F.concat(F.lit("u"), ((F.col("conv_id") + 1) % 50).cast("string")),
        ).alias("in_reply_to_user_id_str"),
        user.alias("user"),
    )
    whole = F.to_json(status, {"ignoreNullFields": "false"})
    retweet = F.to_json(
        F.struct("text", F.struct("text").alias("retweeted_status")),
    )
    deleted = F.struct(
        F.struct(
            F.struct(
                id_text.alias("id_str"), F.col("screen_name").alias("user_id_str")
            ).alias("status")
        ).alias("delete")
    )
    limited = F.struct(F.struct(F.col("conv_id").alias("track")).alias("limit"))
    line = (
        F.when(F.col("kind") == "status", whole)
        .when(F.col("kind") == "delete", F.to_json(deleted))
        .when(F.col("kind") == "limit", F.to_json(limited))
        .when(F.col("kind") == "ignored", retweet)
        .otherwise(F.concat(F.lit("not json "), F.col("text")))
    )
    return rows.select(line.alias("value"))


def mails(spark, sf_dir):
    """Raw messages: plain 8-bit, multipart with base64 text, and nested."""
    rows = scale.spread_if_few(_view(spark, sf_dir, "fx_mail"), "mail_id")
    when = F.timestamp_seconds(F.col("mail_id") * 60 + 1704067200)
    head = F.concat(
        F.lit("From: "),
        F.col("mailfrom"),
        F.lit("\nDate: "),
        dates.rfc822_text(when),
        F.coalesce(F.concat(F.lit("\nSubject: "), F.col("subject")), F.lit("")),
        F.lit("\nMIME-Version: 1.0\n"),
    )
    eight_bit = F.lit(
        "Content-Type: text/plain; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"
    )
    base64 = F.concat(
        F.lit(
            "Content-Type: text/plain; charset=utf-8\n"
            "Content-Transfer-Encoding: base64\n\n"
        ),
        F.base64(F.col("body").cast("binary")),
    )
    attached = F.concat(
        F.lit(
            "\n--outer\nContent-Type: application/pdf\n"
            "Content-Transfer-Encoding: base64\n\n"
        ),
        F.base64(F.col("attached").cast("binary")),
        F.lit("\n--outer--\n"),
    )
    outer = F.lit('Content-Type: multipart/mixed; boundary="outer"\n\n--outer\n')
    inner = F.concat(
        F.lit('Content-Type: multipart/alternative; boundary="inner"\n\n--inner\n'),
        base64,
        F.lit("\n--inner\nContent-Type: text/html\n\n<p>x</p>\n--inner--\n"),
    )
    data = (
        F.when(F.col("mail_id") % 3 == 0, F.concat(head, eight_bit, F.col("body")))
        .when(F.col("mail_id") % 3 == 1, F.concat(head, outer, base64, attached))
        .otherwise(F.concat(head, outer, inner, attached))
    )
    return rows.select(
        "mail_id", "mailfrom", F.array("rcpt1", "rcpt2").alias("rcptto"),
        data.alias("data"),
    )


def push_requests(spark, sf_dir):
    """Requests with the drop packed in a struct."""
    return _view(spark, sf_dir, "fx_push_requests").withColumn(
        "drop", F.struct(F.col("droplet_id").alias("id"), "droplet_title")
    )


def photo_pages(spark, sf_dir):
    """Captured pages of a photo service, with the photo put in front."""
    rows = _view(spark, sf_dir, "fx_photo_pages")
    photo = F.concat(
        F.lit('<img class="big" id="photo" src="http://img.example/'),
        F.col("photo").cast("string"),
        F.lit('.jpg">'),
    )
    return rows.select("url", F.concat(photo, F.col("html")).alias("html"))


def shorteners(spark):
    """A few short domains; a deployment loads its own list (``sources``)."""
    return spark.createDataFrame(
        [("bit.ly",), ("t.co",), ("yfrog.com",), ("flic.kr",)], "domain string"
    )


def control_messages(spark, sf_dir):
    """Channel and river messages as they come from the exchange."""
    return control_text(
        scale.spread_if_few(_view(spark, sf_dir, "fx_control"), "seq")
    )


def control_text(rows):
    """Rows of ``fx_control`` as messages."""
    one = F.to_json(F.struct("id", "river_id", "channel", "parameters"))
    option = F.struct(
        F.col("id").alias("channel_id"), "river_id", "channel", "parameters"
    )
    many = F.to_json(F.struct(F.array(option).alias("channels")))
    of_river = F.col("op").isin("enable", "disable")
    return rows.select(
        F.when(of_river, F.concat(F.lit("web.river."), F.col("op")))
        .otherwise(
            F.concat(F.lit("web.channel."), F.col("channel"), F.lit("."), F.col("op"))
        )
        .alias("routing_key"),
        F.when(of_river, many).otherwise(one).alias("body"),
        "seq",
    )
