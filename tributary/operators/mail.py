"""Captured mail to drops, comments and attachments."""

import hashlib
from email import message_from_bytes

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions import dates, text
from tributary.operators import scale

#: Messages that a task parses at a time.
SLICE = 256

PARSED = (
    "content string, subject string, date string, error string, "
    "attachments array<struct<pos:int,sha256:string,content_type:string,"
    "type:string,payload:binary>>"
)


def recipients(mails):
    """One row per recipient: (mail_id, address).  Bodies are not read."""
    return mails.select("mail_id", F.explode("rcptto").alias("address"))


def with_rivers(mails, rivers):
    """JOIN-9, FLT-7: mails that reach an active river, with ``river_id``.

    Done before parsing, so mail to nowhere is never parsed.  The body waits
    outside the join on addresses and is joined once, by mail.
    """
    active = rivers.where(F.col("river_active") == 1).select(
        F.col("email_id").alias("local"), F.col("id").cast("bigint").alias("river")
    )
    named = recipients(mails).select(
        "mail_id", text.local_part(F.col("address")).alias("local")
    )
    reached = (
        scale.skew_join(named, active, "local", spread_by=["mail_id"])
        .groupBy("mail_id")
        .agg(F.array_sort(F.collect_set("river")).alias("river_id"))
    )
    return mails.join(reached, "mail_id")


def with_tokens(mails, auth_tokens):
    """JOIN-10, SRC-21: mails that name a known token, with ``tokens``."""
    known = auth_tokens.select("token", "type", "data")
    named = recipients(mails).select(
        "mail_id", text.comment_token(F.col("address")).alias("token")
    )
    hits = (
        scale.skew_join(named, known, "token", spread_by=["mail_id"])
        .groupBy("mail_id")
        .agg(
            F.array_sort(F.collect_set(F.struct("token", "type", "data"))).alias(
                "tokens"
            )
        )
    )
    return mails.join(hits, "mail_id")


def message_id(mailfrom, rcptto, data):
    """PRJ-4, FN-1 (Q-15): md5 over sender, recipients as a Python list prints
    them, and the raw message."""
    listed = F.concat(F.lit("['"), F.array_join(rcptto, "', '"), F.lit("']"))
    return F.md5(F.concat(F.encode(mailfrom, "utf-8"), F.encode(listed, "utf-8"), data))


def parse(mails):
    """MAIL-1: message (bytes, or text in UTF-8) to (content, subject, date, attachments, error).

    MIME has no counterpart among Spark's functions, so this one operator runs
    Python, in Arrow batches and with no shuffle.  All other columns pass, the
    raw message does not.  A message that cannot be decoded gets ``error``.
    """
    source = mails.withColumn("data", F.col("data").cast("binary")).withColumn(
        "droplet_orig_id",
        message_id(F.col("mailfrom"), F.col("rcptto"), F.col("data")),
    )
    kept = [f for f in source.schema.fields if f.name != "data"]
    out = T.StructType(kept + T._parse_datatype_string(PARSED).fields)

    return source.mapInPandas(_parsed_batches, out)


def _parsed_batches(batches):
    """Batches with their messages parsed, ``SLICE`` rows at a time, so that the parsed
    texts and attachments of a whole batch are never held together."""
    for whole in batches:
        for first in range(0, len(whole), SLICE):
            batch = whole.iloc[first : first + SLICE].copy()
            parsed = [_parse_one(raw) for raw in batch.pop("data")]
            for name, values in zip(
                ("content", "subject", "date", "error", "attachments"), zip(*parsed)
            ):
                batch[name] = pd.Series(list(values), index=batch.index, dtype=object)
            yield batch


def _parse_one(raw):
    if raw is None:
        return None, None, None, "no message", None
    try:
        message = message_from_bytes(bytes(raw))
        content = _first_text(message)
        attachments = None
        if message.is_multipart():
            tail = message.get_payload()[1:]
            attachments = [_attachment(i, part) for i, part in enumerate(tail)]
        return (
            content,
            _header(message, "Subject"),
            _header(message, "Date"),
            None,
            attachments,
        )
    except (LookupError, UnicodeError, ValueError, TypeError, AttributeError) as e:
        return None, None, None, f"{type(e).__name__}: {e}", None


def _header(message, name):
    value = message.get(name)
    return None if value is None else str(value)


def _first_text(message):
    """First leaf of the first part, decoded by its own character set."""
    while message.is_multipart():
        message = message.get_payload()[0]
    payload = message.get_payload(decode=True)
    return payload.decode(message.get_content_charset("utf-8"))


def _attachment(pos, part):
    payload = part.get_payload(decode=True)
    if payload is None:
        raise ValueError("attachment without a payload of its own")
    if part.get_content_maintype() == "text":
        charset = part.get_content_charset("utf-8")
        payload = payload.decode(charset).encode("utf-8")
    return {
        "pos": pos,
        "sha256": hashlib.sha256(payload).hexdigest(),
        "content_type": part.get_content_type(),
        "type": part.get_content_maintype(),
        "payload": payload,
    }


def accepted(parsed):
    """FLT-7: mails with content and a subject (rivers were checked before)."""
    return parsed.where(
        F.col("error").isNull()
        & text.filled(F.col("content"))
        & text.filled(F.col("subject"))
    )


def to_drops(parsed, store_url="attachments/"):
    """PRJ-4, PRJ-10, FN-17/23: drops of the accepted mails of ``with_rivers``.

    The address of an attachment is ``store_url`` plus its content hash.
    """
    content = text.line_breaks(F.col("content"))
    media = F.transform(
        "attachments",
        lambda a: F.struct(
            F.concat(F.lit(store_url), a["sha256"]).alias("url"),
            a["type"].alias("type"),
            F.lit(False).alias("droplet_image"),
        ),
    )
    return accepted(parsed).select(
        "mail_id",
        F.lit("email").alias("channel"),
        "river_id",
        F.col("mailfrom").alias("identity_orig_id"),
        F.col("mailfrom").alias("identity_username"),
        F.col("mailfrom").alias("identity_name"),
        F.lit(None).cast("string").alias("identity_avatar"),
        "droplet_orig_id",
        F.lit("original").alias("droplet_type"),
        F.col("subject").alias("droplet_title"),
        content.alias("droplet_content"),
        content.alias("droplet_raw"),
        F.lit(None).cast("string").alias("droplet_locale"),
        dates.mail_date(F.col("date")).alias("droplet_date_pub"),
        F.when(F.size("attachments") > 0, media).alias("media"),
    ).where(F.col("droplet_date_pub").isNotNull())


def quarantined(parsed):
    """STR-14: mails that could not be decoded, or have no usable date."""
    bad_date = dates.mail_date(F.col("date")).isNull()
    return parsed.where(F.col("error").isNotNull() | bad_date).select(
        "mail_id", F.coalesce("error", F.lit("no usable date")).alias("error")
    )


def attachments(parsed):
    """MAIL-2: (mail_id, pos, sha256, content_type, type, payload), of accepted
    mails only (Q-23)."""
    return accepted(parsed).select("mail_id", F.inline("attachments"))


def attachment_store(found):
    """SNK-11: one row per content.  The aggregate combines before the shuffle,
    so a file attached to a third of all mails is moved once per task."""
    return found.select("sha256", "content_type", "payload").dropDuplicates(["sha256"])


def to_comments(parsed, api_url, api_key):
    """PRJ-11, SNK-10, FN-24: one comment to post per token of ``with_tokens``."""
    data = lambda key: F.get_json_object("k.data", f"$.{key}")
    usable = parsed.where(F.col("error").isNull() & text.filled(F.col("content")))
    hit = usable.select("mail_id", "mailfrom", "content", F.explode("tokens").alias("k"))
    on_drop = F.col("k.type") == "drop-comment"
    target = F.when(
        on_drop, F.concat(F.lit("drop/"), data("drop_id"))
    ).otherwise(F.concat(F.lit("bucket/"), data("bucket_id")))
    body = F.struct(
        text.line_breaks(F.col("content")).alias("comment_text"),
        F.col("mailfrom").alias("from_email"),
        F.when(on_drop, data("context")).alias("context"),
        F.when(on_drop, data("context_obj_id").try_cast("bigint")).alias("context_obj_id"),
    )
    return hit.select(
        "mail_id",
        F.col("k.token").alias("token"),
        F.col("k.type").alias("type"),
        F.concat(
            F.lit(api_url), target, F.lit("/comment?api_key="), F.lit(api_key)
        ).alias("post_url"),
        F.to_json(body).alias("body"),
    )


def to_retry(outbox, results):
    """FLT-18 (Q-26): comments whose last answer was a server error, or none.

    ``results`` is (mail_id, token, seq, status).
    """
    last = results.groupBy("mail_id", "token").agg(
        F.max_by("status", "seq").alias("status")
    )
    pending = F.col("status").isNull() | (F.col("status") >= 500)
    return outbox.join(last, ["mail_id", "token"], "left").where(pending).drop("status")
