import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import events, registry, scale
from tributary.plans import firehose

PREDICATES = "type string, term string, channel_id bigint, river_id bigint"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def options(spark, *listed):
    return spark.createDataFrame(
        [(c, r, json.dumps({"value": v})) for c, r, v in listed],
        "channel_id bigint, river_id bigint, parameters string",
    )


def test_only_active_options_of_active_rivers(spark):
    rivers = spark.createDataFrame(
        [(1, 1, "a"), (2, 0, "b")], "id bigint, river_active int, email_id string"
    )
    channels = spark.createDataFrame(
        [(1, 1, "rss", 1, "p"), (2, 1, "rss", 0, "p"), (3, 2, "rss", 1, "p"),
         (4, 1, "twitter", 1, "p")],
        "id bigint, river_id bigint, channel string, active int, parameters string",
    )
    assert rows(registry.active_channels(rivers, channels, "rss")) == [(1, 1, "p")]


def test_subscribers_stay_whole_over_several_parts(spark):
    active = spark.createDataFrame(
        [(c, c % 3, '{"value":"u"}') for c in range(25)],
        "channel_id bigint, river_id bigint, parameters string",
    )
    parts = registry.url_subscribers(active, span=10).collect()
    assert len(parts) == 3 and {p["part"] for p in parts} == {0, 1, 2}
    assert sorted(c for p in parts for c in p["channel_ids"]) == list(range(25))
    assert {r for p in parts for r in p["river_ids"]} == {0, 1, 2}


def test_few_subscribers_are_one_row_however_far_apart_their_ids(spark):
    active = spark.createDataFrame(
        [(c * 20_000, c % 3, '{"value":"u"}') for c in range(1000)],
        "channel_id bigint, river_id bigint, parameters string",
    )
    (part,) = registry.url_subscribers(active).collect()
    assert part["part"] == 0 and len(part["channel_ids"]) == 1000


def test_refused_options_are_told(spark):
    active = options(spark, *((c, 1, {"k": f"t{c}"}) for c in range(500)))
    terms = registry.options_to_terms(active)
    assert registry.predicates(active).count() == 500
    refused = registry.over_quota(terms, registry.QUOTA)
    assert refused.count() == 100


def test_a_name_with_two_ids_gives_one_row(spark):
    ids = spark.createDataFrame(
        [("ann", "17"), ("ann", "18")], "screen_name string, user_id string"
    )
    active = options(spark, (1, 1, {"person": "ann"}))
    assert rows(registry.predicates(active, user_ids=ids).select("term")) == [("17",)]


def test_quota_admits_options_while_there_is_room(spark):
    active = options(
        spark, (1, 1, {"k": "a,b"}), (2, 1, {"k": "c,d"}), (3, 1, {"k": "e"}),
        (4, 1, {"k": "a"}), (5, 1, {"user": "x"}),
    )
    got = registry.predicates(active, quota={"track": 3, "follow": 5})
    assert rows(got.select("channel_id", "term")) == [
        (1, "a"), (1, "b"), (2, "c"), (2, "d"), (5, "x"),
    ]


def test_long_and_empty_terms_go(spark):
    active = options(spark, (1, 1, {"k": "ok,," + "x" * 61 + "," + "y" * 60}))
    got = {r["term"] for r in registry.predicates(active).collect()}
    assert got == {"ok", "y" * 60}


def test_user_ids_replace_names_and_unknown_names_go(spark):
    ids = spark.createDataFrame([("ann", "17")], "screen_name string, user_id string")
    active = options(spark, (1, 1, {"person": "@Ann,bob", "k": "bob"}))
    got = rows(registry.predicates(active, user_ids=ids).select("type", "term"))
    assert got == [("follow", "17"), ("track", "bob")]


def test_first_writer_or_all_channels(spark):
    active = options(spark, (2, 5, {"k": "a"}), (1, 4, {"k": "a"}))
    assert len(rows(registry.predicates(active))) == 2
    kept = registry.predicates(active, first_writer_wins=True)
    assert rows(kept) == [("track", "a", 1, 4)]


def test_flat_map_prefers_the_later_type(spark):
    known = spark.createDataFrame(
        [("follow", "a", 1, 10), ("track", "a", 1, 20), ("track", "a", 2, 30)],
        PREDICATES,
    )
    flat = registry.predicate_maps(known).first()
    assert flat["channels"] == {1: 20, 2: 30}


def test_diff_is_symmetric_and_empty_for_equals(spark):
    old = spark.createDataFrame(
        [("track", "a", 1, 1), ("track", "b", 1, 1)], PREDICATES
    )
    new = spark.createDataFrame(
        [("track", "a", 1, 2), ("follow", "c", 1, 1)], PREDICATES
    )
    assert rows(registry.predicate_diff(old, new)) == [
        ("follow", "c", 1, "added"), ("track", "a", 1, "moved"),
        ("track", "b", 1, "removed"),
    ]
    assert registry.predicate_diff(old, old).isEmpty()


def test_add_then_remove_is_identity(spark):
    old = spark.createDataFrame([("track", "a", 1, 1)], PREDICATES)
    more = spark.createDataFrame([("track", "b", 2, 2)], PREDICATES)
    key = registry.PREDICATE_KEY
    added = registry.add_entries(old, more, key)
    assert len(rows(added)) == 2
    assert rows(registry.remove_entries(added, more, key)) == rows(old)
    again = spark.createDataFrame([("track", "a", 1, 9)], PREDICATES)
    assert rows(registry.add_entries(old, again, key)) == rows(old)


def message(key, seq, **fields):
    return (key, json.dumps(fields), seq)


def test_control_messages_fold_in_order(spark):
    option = json.dumps({"value": "u"})
    listed = spark.createDataFrame(
        [
            message("web.channel.rss.add", 1, id=1, river_id=7, channel="rss",
                    parameters=option),
            message("web.channel.rss.delete", 2, id=1, river_id=7, channel="rss",
                    parameters=option),
            message("web.river.enable", 3, channels=[
                dict(channel_id=2, river_id=8, channel="rss", parameters=option),
                dict(channel_id=3, river_id=8, channel="twitter", parameters=option),
            ]),
            message("web.river.disable", 4, channels=[
                dict(channel_id=9, river_id=9, channel="rss", parameters=option)]),
            message("web.channel.rss.edit", 5, id=4, river_id=7, channel="rss",
                    parameters=option),
        ],
        "routing_key string, body string, seq bigint",
    )
    current = spark.createDataFrame(
        [("u", 9, 9), ("u", 1, 10)], "url string, river_id bigint, channel_id bigint"
    )
    changes = events.channel_changes(listed, "rss")
    folded = events.fold_subscriptions(current, changes)
    assert rows(folded) == [("u", 1, 10), ("u", 8, 2)]


def test_predicate_events_keep_the_ids_of_their_option(spark):
    listed = spark.createDataFrame(
        [message("web.channel.twitter.add", 1, id="5", river_id="6", channel="twitter",
                 parameters=json.dumps({"value": {"k": "a,b", "user": "c"}}))],
        "routing_key string, body string, seq bigint",
    )
    empty = spark.createDataFrame([], PREDICATES)
    changes = events.channel_changes(listed, "twitter")
    assert rows(events.fold_predicates(empty, changes)) == [
        ("follow", "c", 5, 6), ("track", "a", 5, 6), ("track", "b", 5, 6),
    ]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_gives_the_rows_of_a_plain_join(spark, how):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 100))
        .alias("key"),
        "id",
    )
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4), ("none", 5)], "key string, v int"
    )
    want = left.join(right, "key", how).select("key", "id", "v")
    salted = scale.skew_join(
        left, right, "key", how, ["id"], spread=8, min_rows=1, small=False
    ).select("key", "id", "v")
    assert salted.exceptAll(want).isEmpty() and want.exceptAll(salted).isEmpty()
    hot = [r["key"] for r in scale.hot_keys(left, "key", min_rows=500).collect()]
    assert hot == ["hot"]


def test_size_check_counts_rows_and_bytes(spark):
    rows_ = spark.range(50).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert scale.is_small(rows_)
    assert not scale.is_small(rows_, max_rows=49)
    assert not scale.is_small(rows_, max_bytes=10_000)


def test_large_registries_match_as_small_ones(spark, monkeypatch):
    known = spark.createDataFrame(
        [("track", t, c, c % 3) for c, t in enumerate(["the", "of the", "c++", "x"] * 5)]
        + [("follow", "u1", 90, 1)],
        PREDICATES,
    )
    drops = spark.range(60).select(
        "id", F.lit("u1").alias("identity_orig_id"),
        F.when(F.col("id") % 3 == 0, "the end of c++").otherwise("the x").alias("droplet_raw"),
        F.lit(None).cast("string").alias("in_reply_to_user_id"),
    )
    want = {k: rows(firehose.rivers_of(drops, known, k)) for k in ("track", "follow")}
    monkeypatch.setattr(scale, "is_small", lambda *a, **k: False)
    got = {k: rows(firehose.rivers_of(drops, known, k)) for k in ("track", "follow")}
    assert got == want and len(want["track"]) == len(want["follow"]) == 60
