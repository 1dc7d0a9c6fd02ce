"""Signed batches of drops for outside deployments, and the log of pushes."""

from pyspark.sql import functions as F

from tributary.functions import dates, signing
from tributary.operators import scale

#: Fixed value: push messages come under this key plus the deployment's kind.
PUSH_KEY = "web.bucket.push."

#: About how many bytes of drops a payload holds.
PAYLOAD_BYTES = 4 << 20

_TARGET = ["bucket_id", "post_url", "client_id", "client_secret"]


def wanted(requests, kind):
    """FLT-15 (Q-28): requests for deployments of ``kind``, by the whole key."""
    return requests.where(F.col("routing_key") == PUSH_KEY + kind)


def parsed_messages(rows):
    """SRC-14: push messages read by ``sources.readers`` in the columns used
    here; ids may have come as text."""
    drops = F.transform("m.drops", lambda d: d.withField("id", d["id"].try_cast("bigint")))
    return rows.select(
        "routing_key",
        F.col("m.bucket_id").try_cast("bigint").alias("bucket_id"),
        "m.post_url",
        "m.client_id",
        "m.client_secret",
        drops.alias("drops"),
    )


def drops_of(messages):
    """SET-2: one row per drop of a push message."""
    return messages.select(*_TARGET, F.explode("drops").alias("drop"))


def _signed(batches):
    encoded = signing.base64_text(F.col("payload"))
    checksum = signing.hmac_sha256(F.col("client_secret"), F.col("payload"))
    return batches.withColumns({"drops_b64": encoded, "checksum": checksum}).drop(
        "client_secret"
    )


def _with_body(outbox):
    body = signing.form_encoded(
        drops=F.col("drops_b64"),
        checksum=F.col("checksum"),
        client_id=F.col("client_id"),
    )
    return outbox.withColumn("body", body)


def outbox(requests, most=PAYLOAD_BYTES):
    """AGG-13, PRJ-14, SNK-9 (Q-22): signed payloads of per-drop requests.

    ``requests`` holds (bucket_id, post_url, client_id, client_secret, drop).
    A bucket whose drops take over ``most`` bytes gives several payloads of
    about that size, each complete and signed by itself, instead of one row no
    task can hold.  Of several requests for a drop the smallest in text counts.
    """
    size = F.octet_length(F.to_json("drop"))
    once = (
        requests.select(*_TARGET, "drop", F.col("drop.id").alias("_id"))
        .groupBy(*_TARGET, "_id")
        .agg(F.min_by("drop", F.to_json("drop")).alias("drop"))
    )
    packed = (
        scale.with_part(once, _TARGET, "_id", size, most)
        .groupBy(*_TARGET, "part")
        .agg(F.to_json(F.array_sort(F.collect_list("drop"))).alias("payload"))
    )
    return _with_body(_signed(packed))


def outbox_of_messages(messages):
    """PRJ-14, SNK-9 for messages that list their drops: one payload each, made
    within the row."""
    payload = F.to_json("drops").alias("payload")
    return _with_body(_signed(messages.select(*_TARGET, payload)))


def undelivered(sent, results):
    """STR-11, FLT-18: payloads without a 200 yet; they go out again.

    ``results`` is (bucket_id, checksum, status).
    """
    done = results.where(F.col("status") == 200).select("bucket_id", "checksum")
    return sent.join(done.distinct(), ["bucket_id", "checksum"], "left_anti")


def update_log(log, pushed, as_of):
    """JOIN-11, SET-2, SNK-8: mark the pushed (bucket, drop) pairs in the log."""
    pairs = (
        pushed.select("bucket_id", "droplet_id")
        .distinct()
        .withColumn("_pushed", F.lit(True))
    )
    hit = F.col("_pushed").isNotNull()
    when = dates.log_text(dates.instant(as_of))
    return log.join(pairs, ["bucket_id", "droplet_id"], "left").select(
        "bucket_id",
        "droplet_id",
        F.when(hit, F.lit(1))
        .otherwise(F.col("droplet_push_status"))
        .alias("droplet_push_status"),
        F.when(hit, when)
        .otherwise(F.col("droplet_date_push"))
        .alias("droplet_date_push"),
    )


def update_pending(settings, pushed):
    """AGG-8, FLT-17 (Q-21: never below 0): pending counts after a push."""
    counts = pushed.groupBy("bucket_id").agg(F.count(F.lit(1)).alias("_pushed"))
    less = F.greatest(
        F.lit(0).cast("bigint"), F.col("pending_drop_count") - F.col("_pushed")
    )
    touched = F.col("_pushed").isNotNull() & (F.col("pending_drop_count") > 0)
    return settings.join(counts, "bucket_id", "left").select(
        "bucket_id",
        F.when(touched, less)
        .otherwise(F.col("pending_drop_count"))
        .alias("pending_drop_count"),
    )


def log_changes(log, pushed, as_of):
    """JOIN-11, SNK-8: the rows of the log that a push changes, as they are then."""
    pairs = pushed.select("bucket_id", "droplet_id").distinct()
    return log.join(pairs, ["bucket_id", "droplet_id"], "left_semi").select(
        "bucket_id",
        "droplet_id",
        F.lit(1).alias("droplet_push_status"),
        dates.log_text(dates.instant(as_of)).alias("droplet_date_push"),
        F.lit(False).alias("deleted"),
    )


def pending_changes(settings, pushed, as_of=None):
    """AGG-8, FLT-17 (Q-21): the pending counts that a push changes."""
    counts = pushed.groupBy("bucket_id").agg(F.count(F.lit(1)).alias("_pushed"))
    less = F.greatest(F.lit(0).cast("bigint"), F.col("pending_drop_count") - F.col("_pushed"))
    open_ = settings.where(F.col("pending_drop_count") > 0)
    return open_.join(counts, "bucket_id").select(
        "bucket_id", less.alias("pending_drop_count"), F.lit(False).alias("deleted")
    )


def pending_by_log(log):
    """Check on the two tables of SNK-8: drops of each bucket not pushed yet."""
    return log.groupBy("bucket_id").agg(
        F.count_if(F.col("droplet_push_status") == 0).alias("pending")
    )
