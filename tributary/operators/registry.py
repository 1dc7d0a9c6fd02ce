"""Who subscribed to what: channel options, URLs and filter predicates."""

from pyspark.sql import functions as F

from tributary.functions import text
from tributary.operators import scale

#: Most terms of a type, and the longest term.
QUOTA = {"track": 400, "follow": 5000}
TYPE_ORDER = ("follow", "track")

PREDICATE_KEY = ["type", "term", "channel_id"]
SUBSCRIPTION_KEY = ["url", "channel_id"]


def active_channels(rivers, river_channels, channel):
    """SRC-1/2, JOIN-1, FLT-1: active options of ``channel`` in active rivers."""
    options = river_channels.where(
        (F.col("channel") == channel) & (F.col("active") == 1)
    ).select(F.col("id").alias("channel_id"), "river_id", "parameters")
    live = rivers.where(F.col("river_active") == 1).select(
        F.col("id").cast("bigint").alias("river_id")
    )
    options = options.withColumn("river_id", F.col("river_id").cast("bigint"))
    return scale.skew_join(
        options, live, "river_id", spread_by=["channel_id"]
    ).select("channel_id", "river_id", "parameters")


def subscriptions(active):
    """SRC-1: RSS options as (url, river_id, channel_id), one row each."""
    url = F.get_json_object("parameters", "$.value")
    return active.select(url.alias("url"), "river_id", "channel_id").where(
        F.col("url").isNotNull()
    )


def url_subscribers(active, span=scale.PART_SPAN):
    """AGG-1: distinct rivers and channels of each URL, in bounded parts."""
    return subscriber_parts(subscriptions(active), span)


def subscriber_parts(subs, span=scale.PART_SPAN):
    """(url, part, river_ids, channel_ids); the parts of a URL are disjoint in
    channels.  A URL has one part unless it has more than ``span`` subscribers."""
    return (
        scale.with_part(subs, ["url"], "channel_id", most=span)
        .groupBy("url", "part")
        .agg(
            F.array_sort(F.collect_set("river_id")).alias("river_ids"),
            F.array_sort(F.collect_set("channel_id")).alias("channel_ids"),
        )
    )


def options_to_terms(options, *also):
    """SRC-2, FN-20/21: Twitter options to (type, term, channel_id, river_id),
    with the columns named in ``also`` kept."""
    values = F.from_json("parameters", "value map<string,string>")["value"]
    keyed = options.select(
        "channel_id", "river_id", *also, F.explode(values).alias("key", "value")
    )
    return keyed.select(
        text.predicate_type(F.col("key")).alias("type"),
        F.explode(text.normal_terms(F.col("value"))).alias("term"),
        "channel_id",
        "river_id",
        *also,
    )


def with_user_ids(terms, user_ids):
    """JOIN-14: replace the screen name of a follow term by the user's id.

    A name without an id gives NULL, which ``valid_terms`` discards.  Only
    follow terms take part; ``user_ids`` is (screen_name, user_id).
    """
    names = terms.where(F.col("type") == "follow")
    # A name with several captured ids stands for the smallest.
    ids = user_ids.groupBy(F.col("screen_name").alias("term")).agg(
        F.min(F.col("user_id").cast("string")).alias("user_id")
    )
    looked_up = scale.skew_join(names, ids, "term", "left", ["channel_id"]).select(
        "type", F.col("user_id").alias("term"), "channel_id", "river_id"
    )
    return terms.where(F.col("type") != "follow").unionByName(looked_up)


def valid_terms(terms, max_len=text.MAX_TERM):
    """FLT-9."""
    return terms.where(F.col("term").isNotNull() & (F.length("term") <= max_len))


def within_quota(terms, quota):
    """FLT-10, WIN-4, AGG-7: admit an option while earlier ones left room.

    ``quota`` is a limit per type, such as ``QUOTA``; None admits all.  What is
    refused comes from ``over_quota``.

    An option is admitted if fewer than ``limit`` terms were registered before
    it.  Options come in order of channel id, so all options are admitted up to
    the one that first registered the limit-th term: one top-k per type finds
    it, and no window runs over a whole type.  The terms of each type are
    counted first (one row per type); within the quota nothing is cut.
    """
    limits = quota or {}
    if not limits:
        return terms
    held = {row["type"]: row["terms"] for row in term_counts(terms).collect()}
    full = sorted(k for k, limit in limits.items() if held.get(k, 0) >= limit)
    if not full:
        return terms
    first = terms.groupBy("type", "term").agg(
        F.min("channel_id").alias("first_channel")
    )
    cutoffs = None
    for kind in full:
        earliest = (
            first.where(F.col("type") == kind)
            .select("first_channel")
            .orderBy("first_channel")
            .limit(limits[kind])
        )
        cutoff = earliest.agg(F.max("first_channel").alias("cutoff")).select(
            F.lit(kind).alias("type"), "cutoff"
        )
        cutoffs = cutoff if cutoffs is None else cutoffs.unionByName(cutoff)
    # One row per type of the quota: the broadcast is bounded by the parameter.
    admitted = terms.join(F.broadcast(cutoffs), "type", "left").where(
        F.col("cutoff").isNull() | (F.col("channel_id") <= F.col("cutoff"))
    )
    return admitted.drop("cutoff")


def over_quota(terms, quota):
    """FLT-10: the options that ``within_quota`` refuses."""
    admitted = within_quota(terms, quota).select(*PREDICATE_KEY).distinct()
    return terms.join(admitted, PREDICATE_KEY, "left_anti")


def first_writer(terms):
    """WIN-3 (Q-9): a term keeps only the first channel that registered it."""
    owner = F.min(F.struct("channel_id", "river_id")).alias("owner")
    return (
        terms.groupBy("type", "term")
        .agg(owner)
        .select("type", "term", "owner.channel_id", "owner.river_id")
    )


def predicates(
    active, user_ids=None, max_len=text.MAX_TERM, quota=None, first_writer_wins=False
):
    """The registry in long form: (type, term, channel_id, river_id)."""
    terms = options_to_terms(active)
    if user_ids is not None:
        terms = with_user_ids(terms, user_ids)
    terms = within_quota(valid_terms(terms, max_len), quota)
    return first_writer(terms) if first_writer_wins else terms.distinct()


def term_counts(registry):
    """AGG-7: registered terms per type."""
    return registry.groupBy("type").agg(F.countDistinct("term").alias("terms"))


def registry_maps(registry, span=scale.PART_SPAN):
    """AGG-2: (type, term, part) to a map of channel to river, bounded parts."""
    return _channel_map(registry, ["type", "term"], span)


def predicate_maps(registry, span=scale.PART_SPAN):
    """AGG-3: the types merged; where both hold a channel, the later type wins."""
    order = F.array_position(F.array(*[F.lit(t) for t in TYPE_ORDER]), F.col("type"))
    merged = registry.groupBy("term", "channel_id").agg(
        F.max(F.struct(order.alias("o"), "river_id"))["river_id"].alias("river_id")
    )
    return _channel_map(merged, ["term"], span)


def _channel_map(registry, key, span):
    pairs = F.array_sort(F.collect_set(F.struct("channel_id", "river_id")))
    dealt = scale.with_part(registry, key, "channel_id", most=span)
    return dealt.groupBy(*key, "part").agg(F.map_from_entries(pairs).alias("channels"))


def predicate_diff(old, new):
    """SET-3 (Q-11): entries added, removed, or moved to another river."""
    before = old.select(*PREDICATE_KEY, F.col("river_id").alias("old_river"))
    after = new.select(*PREDICATE_KEY, F.col("river_id").alias("new_river"))
    change = (
        F.when(F.col("old_river").isNull(), "added")
        .when(F.col("new_river").isNull(), "removed")
        .when(F.col("old_river") != F.col("new_river"), "moved")
    )
    return (
        before.join(after, PREDICATE_KEY, "full")
        .withColumn("change", change)
        .where(F.col("change").isNotNull())
        .select(*PREDICATE_KEY, "change")
    )


def _merged(current, other, key, prefer_other):
    """Full join of two keyed tables; ``prefer_other`` picks the side to keep."""
    values = [c for c in current.columns if c not in key]
    here = current.select(*key, F.struct(F.lit(1), *values).alias("_here"))
    both = here.join(other, key, "full")
    picked = F.when(prefer_other, F.col("_there")).otherwise(F.col("_here"))
    rows = both.select(*key, picked.alias("_row")).where(F.col("_row").isNotNull())
    return rows.select(*key, *[F.col(f"_row.{v}").alias(v) for v in values]).select(
        *current.columns
    )


def add_entries(current, added, key):
    """SET-5/7: union; an entry that is already there stays as it is."""
    values = [c for c in current.columns if c not in key]
    # Of several rows with a key the smallest, the same one in every run.
    one_each = added.groupBy(*key).agg(
        F.min(F.struct(F.lit(1), *values)).alias("_there")
    )
    return _merged(current, one_each, key, F.col("_here").isNull())


def remove_entries(current, removed, key):
    """SET-6/7 (Q-3): take out exactly the named entries; a term or URL with no
    entry left is gone from the long form by itself."""
    return current.join(removed.select(*key).distinct(), key, "left_anti")


def fold_events(current, events, key):
    """STR-4/5: the table after ``events``, the last event of an entry winning.

    ``events`` has the columns of ``current`` plus ``op`` (add|delete) and
    ``seq``.  The last event is found by an aggregate that combines before the
    shuffle, so an entry with a long history stays cheap; the events are read
    once.
    """
    values = [c for c in current.columns if c not in key]
    last = events.groupBy(*key).agg(
        F.max_by(F.struct("op", *values), "seq").alias("_last")
    )
    added = F.when(
        F.col("_last.op") == "add",
        F.struct(F.lit(1), *[F.col(f"_last.{v}").alias(v) for v in values]),
    )
    folded = last.select(*key, F.lit(True).alias("_event"), added.alias("_there"))
    return _merged(current, folded, key, F.col("_event").isNotNull())


def entry_changes(before, changes, key):
    """SET-3, STR-8: what ``changes`` really change in ``before``, as rows of its
    columns with ``change`` (added|removed|moved) and ``deleted``.

    The last event of an entry counts; one that leaves the entry as it is gives no row.
    ``before`` need only hold the entries that the events name.
    """
    values = [c for c in before.columns if c not in key]
    last = changes.groupBy(*key).agg(F.max_by(F.struct("op", *values), "seq").alias("_last"))
    held = before.select(*key, F.struct(F.lit(1), *values).alias("_held"))
    new, old = F.struct(*[F.col(f"_last.{v}") for v in values]), F.struct(*[F.col(f"_held.{v}") for v in values])
    adds = F.col("_last.op") == "add"
    change = (
        F.when(adds & F.col("_held").isNull(), "added")
        .when(adds & (new != old), "moved")
        .when(~adds & F.col("_held").isNotNull(), "removed")
    )
    rows = last.join(held, key, "left").withColumn("change", change).where("change is not null")
    kept = F.when(adds, new).otherwise(old)
    return rows.select(
        *key, *[kept[v].alias(v) for v in values], "change", (~adds).alias("deleted")
    ).select(*before.columns, "change", "deleted")


def remembered_ids(known, found):
    """SNK-12: the user-id table after new look-ups; the known id stays."""
    return add_entries(known, found, ["screen_name"])

