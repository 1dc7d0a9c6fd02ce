"""Control messages: subscriptions and predicates that users add and remove."""

from pyspark.sql import functions as F

from tributary import schemas
from tributary.functions import text
from tributary.operators import registry

#: Routing keys of the control messages.
CHANNEL_KEY, RIVER_KEY = "web.channel", "web.river"
RIVER_OPS = {"web.river.enable": "add", "web.river.disable": "delete"}


def bound_to(messages, patterns):
    """STR-3, FLT-8: messages whose routing key matches one of the patterns."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | text.routing_key_matches(F.col("routing_key"), pattern)
    return messages.where(hit)


def channel_changes(messages, channel):
    """SRC-8/9, STR-5 (Q-4, Q-13): (channel_id, river_id, parameters, op, seq).

    ``messages`` is (routing_key, body, seq).  A channel message names one
    option; a river message lists options of any channel.
    """
    key = F.col("routing_key")
    one = F.from_json("body", schemas.CHANNEL_EVENT)
    channel_op = F.when(
        key == f"{CHANNEL_KEY}.{channel}.add", "add"
    ).when(key == f"{CHANNEL_KEY}.{channel}.delete", "delete")
    options = messages.select(
        one.alias("m"), channel_op.alias("op"), "seq", F.lit(0).alias("at")
    ).select(
        F.col("m.id").alias("channel_id"),
        "m.river_id",
        "m.channel",
        "m.parameters",
        "op",
        "seq",
        "at",
    )
    listed = F.from_json("body", schemas.RIVER_EVENT)["channels"]
    river_op = F.lit(None).cast("string")
    for name, op in RIVER_OPS.items():
        river_op = F.when(key == name, op).otherwise(river_op)
    rivers = messages.where(key.isin(*RIVER_OPS)).select(
        F.posexplode(listed).alias("at", "m"), river_op.alias("op"), "seq"
    ).select(
        "m.channel_id", "m.river_id", "m.channel", "m.parameters", "op", "seq", "at"
    )
    return (
        options.unionByName(rivers)
        .where((F.col("channel") == channel) & F.col("op").isNotNull())
        .select(
            F.col("channel_id").try_cast("bigint").alias("channel_id"),
            F.col("river_id").try_cast("bigint").alias("river_id"),
            "parameters",
            "op",
            F.struct("seq", "at").alias("seq"),
        )
    )


def subscription_changes(changes):
    """RSS changes as (url, channel_id, river_id, op, seq)."""
    url = F.get_json_object("parameters", "$.value")
    return changes.select(
        url.alias("url"), "channel_id", "river_id", "op", "seq"
    ).where(F.col("url").isNotNull())


def added_subscriptions(changes):
    """STR-10: (url, channel_id, river_id) of the subscriptions that ``changes`` leave
    added, each once."""
    last = changes.groupBy("url", "channel_id").agg(F.max_by(F.struct("op", "river_id"), "seq").alias("l"))
    return last.where(F.col("l.op") == "add").select("url", "channel_id", "l.river_id")


def predicate_changes(changes):
    """Twitter changes as (type, term, channel_id, river_id, op, seq) (Q-10)."""
    terms = registry.options_to_terms(changes, "op", "seq")
    return registry.valid_terms(terms)


def fold_subscriptions(current, changes):
    """SET-7, STR-5: (url, river_id, channel_id) after the changes."""
    return registry.fold_events(
        current, subscription_changes(changes), registry.SUBSCRIPTION_KEY
    )


def fold_predicates(current, changes):
    """SET-5/6, STR-4: the registry after the changes."""
    return registry.fold_events(
        current, predicate_changes(changes), registry.PREDICATE_KEY
    )
