import base64
import hashlib
import hmac
import random
import re
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from tributary.functions import dates, signing, text, urls
from tributary.operators import tweets


def one(spark, value, function):
    row = spark.createDataFrame([(value,)], "v string").select(
        function(F.col("v")).alias("x")
    )
    return row.first()["x"]


@pytest.mark.parametrize(
    "value, terms",
    [
        ("@#Foo", ["foo"]),
        ("#@Foo", ["@foo"]),
        (" @Bar ,", ["bar"]),
        ("a b, C\t", ["a b", "c"]),
    ],
)
def test_terms_are_cleaned_in_the_given_order(spark, value, terms):
    assert one(spark, value, text.normal_terms) == terms


def test_predicate_type(spark):
    assert one(spark, "Person", text.predicate_type) == "follow"
    assert one(spark, "USER", text.predicate_type) == "follow"
    assert one(spark, "keyword", text.predicate_type) == "track"


@pytest.mark.parametrize(
    "html, found",
    [
        ('<a class="b" href="u1" src="u2">', [("a", "u2")]),
        ("<a href='u'>", []),
        ('<abbr href="v">', [("a", "v")]),
        ('<IMG SRC="w.png"><a href="x">', [("img", "w.png"), ("a", "x")]),
    ],
)
def test_tag_addresses(spark, html, found):
    assert [tuple(x) for x in one(spark, html, text.tag_urls)] == found


def test_bare_addresses_are_those_left_without_tags(spark):
    got = one(spark, '<a href="http://in.tag/">x</a> http://out/ HTTPS://no/', text.bare_urls)
    assert got == ["http://out/"]


@pytest.mark.parametrize(
    "url, host",
    [
        ("http://A.b:80/x", "A.b:80"),
        ("http://➡.ws/x", "➡.ws"),
        ("//t.co", "t.co"),
        ("bit.ly/x", ""),
        ("http://tk./a b|c", "tk."),
    ],
)
def test_netloc(spark, url, host):
    assert one(spark, url, urls.netloc) == host


def test_image_links_and_photo_services(spark):
    assert one(spark, "a.JPG?x#y", urls.is_image)
    assert not one(spark, "a.jpgx", urls.is_image)
    assert one(spark, "http://yfrog.com/x", urls.photo_address) == "http://yfrog.com/x:iphone"
    shown = "http://twitpic.com/show/large/ab"
    assert one(spark, "http://twitpic.com/ab", urls.photo_address) == shown
    assert one(spark, "http://twitpic.com", urls.photo_address) is None


def test_photo_of_a_page(spark):
    html = '<img src="no"><img class="big" id="photo" src="yes">'
    page = F.lit("http://plixi.com/p/1")
    assert one(spark, html, lambda c: urls.page_photo(page, c)) == "yes"
    flickr = F.lit("http://flic.kr/p/1")
    assert one(spark, html, lambda c: urls.page_photo(flickr, c)) is None


def test_path_parts(spark):
    url = "http://h/a/b.JPG;p?q#f"
    assert one(spark, url, urls.basename) == "b.JPG"
    assert one(spark, url, urls.extension) == "jpg"


def test_hmac_base64_and_form_agree_with_python(spark):
    cases = [
        ("k1", "payload one"),
        ("k" * 64, "x" * 200),
        ("é" * 50, "añ b"),
        ("", ""),
        ("k" * 80, "*~ +/="),
    ]
    rows = spark.createDataFrame(cases, "k string, m string").select(
        signing.hmac_sha256(F.col("k"), F.col("m")).alias("h"),
        signing.base64_text(F.col("m")).alias("b"),
        signing.form_encoded(a=F.col("m")).alias("f"),
    )
    for (key, message), row in zip(cases, rows.collect()):
        k, m = key.encode(), message.encode()
        assert row["h"] == hmac.new(k, m, hashlib.sha256).hexdigest()
        assert row["b"] == base64.b64encode(m).decode()
        assert row["f"] == "a=" + quote_plus(message).replace("~", "%7E")


@pytest.mark.parametrize(
    "value, epoch",
    [
        ("Mon, 01 Jan 2024 02:00:00 +0200", 1704067200),
        ("1 Jan 2024 00:00:00 GMT", 1704067200),
        ("2024-01-01 00:00:00", 1704067200),
        ("2024-01-01T01:00:00+01:00", 1704067200),
        ("Mon, 1 Jan 2024 00:00:00 +0000 (UTC)", 1704067200),
        ("no date", None),
        ("Sunday, 06-Nov-94 08:49:37 GMT", 784111777),
        ("Sun Nov  6 08:49:37 1994", 784111777),
        ("Sun, 06 Nov 94 03:49:37 EST", 784111777),
        ("6 Nov 94 08:49:37 UT", 784111777),
        ("Mon, 1 Jan 24 00:00:00 +0000", 1704067200),
        ("Sun, 31 Dec 2023 16:00:00 PST (winter)", 1704067200),
        ("1 January 2024 00:00:00 Z", 1704067200),
        ("January 1, 2024 01:00:00 +0100", 1704067200),
        ("2024/01/01 00:00:00", 1704067200),
        ("2024-01-01", 1704067200),
        ("Mon, 1 Jan 2024", 1704067200),
        ("Mon, 1 Jan 2024 00:00:00 XYZ", None),
    ],
)
def test_mail_dates(spark, value, epoch):
    assert one(spark, value, lambda c: F.unix_seconds(dates.mail_date(c))) == epoch


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        row = spark.range(1).select(
            dates.rfc822_text(dates.instant(1704067200)).alias("out"),
            F.unix_seconds(
                dates.tweet_date(F.lit("Mon Jan 01 00:00:00 +0000 2024"))
            ).alias("tweet"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["out"] == "Mon, 01 Jan 2024 00:00:00 +0000"
    assert row["tweet"] == 1704067200


def test_routing_keys(spark):
    match = lambda c: text.routing_key_matches(c, "web.river.*")
    assert one(spark, "web.river.enable", match)
    assert not one(spark, "web.river.a.b", match)
    assert not one(spark, "webxriver.enable", match)


def asked_for(term, content):
    """What the matcher must do, one pattern per token."""
    for token in [t for t in term.split() if t]:
        quoted = re.escape(token)
        pattern = rf"\b{quoted}\b|((\s|^){quoted}(\s|$))"
        if not re.search(pattern, content, re.A | re.I):
            return False
    return True


CASES = [
    ("le", "Le chat"), ("le", "elles"), ("le", "élé le"), ("le", "éle"),
    ("of the", "the end of"), ("c++", "use c++ now"), ("c++", "c++11"),
    ("++", "a ++ b"), ("++", "a++b"), ("++", "a ++b"), ("++", "++b"),
    ("é", "aéb"), ("é", "é"), ("é", "bé"), ("foo-bar", "(foo-bar),"),
    ("foo-bar", "xfoo-bar"), ("#a", "b#a"), ("#a", "c #a d"), ("#a", ".#a"),
    ("a\\Eb", "x a\\Eb y"), ("日本", "日本 x"), ("日本", "私日本"), ("日本", "a日本b"),
    ("für", "FüR"), ("für", "FÜR"), ("l'été", "l'été,"), ("a_b", "a_b-c"),
    ("-a", "b-a"), ("a-", "a-b"), ("", "x"),
]


def test_track_match_agrees_with_patterns(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", "A", "_", "1", "é", "-", "+", ".", "'", " ", "\t", "\n", "日"]
    texts = [c for _, c in CASES] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        for _ in range(400)
    ]
    terms = {t for t, _ in CASES if t} | {
        " ".join(
            "".join(rng.choice(alphabet[:10]) for _ in range(rng.randint(1, 4)))
            for _ in range(rng.randint(1, 2))
        ).lower()
        for _ in range(150)
    }
    drops = spark.createDataFrame(
        list(enumerate(texts)), "id bigint, droplet_raw string"
    )
    registry = spark.createDataFrame(
        [("track", t, 1, 1) for t in terms],
        "type string, term string, channel_id bigint, river_id bigint",
    )
    got = {tuple(r) for r in tweets.track_match(drops, registry).collect()}
    want = {
        (i, t) for i, content in enumerate(texts) for t in terms if asked_for(t, content)
    }
    assert got == want
    assert len(want) > 500
