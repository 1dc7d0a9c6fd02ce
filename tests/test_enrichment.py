from pyspark.sql import functions as F

from tributary.operators import entities, media
from tributary.plans import enrichment

URLS = "url string, status int, location string"
PROBES = "url string, width int, height int"


def domains(spark):
    return spark.createDataFrame([("s.co",), ("➡.ws",)], "domain string")


def expand(spark, captured):
    redirects = spark.createDataFrame(captured, URLS)
    rows = media.expansions(domains(spark), redirects).collect()
    return {r["url"]: r["full_url"] for r in rows}


def test_redirects_stop_after_five_hops(spark):
    chain = [(f"http://s.co/{i}", 301, f"http://s.co/{i + 1}") for i in range(6)]
    got = expand(spark, chain)
    assert got["http://s.co/0"] == "http://s.co/5"
    assert got["http://s.co/1"] == "http://s.co/6"


def test_redirect_outcomes(spark):
    got = expand(
        spark,
        [
            ("http://S.co/a", 302, "http://long/"),
            ("http://s.co/b", 404, "http://long/"),
            ("http://s.co/c", 200, None),
            ("http://➡.ws/d", 301, "http://s.co/a2"),
            ("http://other/e", 301, "http://long/"),
            ("http://s.co/loop", 301, "http://s.co/loop"),
        ],
    )
    assert got == {
        "http://S.co/a": "http://long/",
        "http://➡.ws/d": "http://s.co/a2",
        "http://s.co/loop": "http://s.co/loop",
    }


def enriched(spark, raw, probes, links=None, **options):
    drops = spark.createDataFrame(
        [(1, raw, raw, links)],
        "id bigint, droplet_content string, droplet_raw string, "
        "links array<struct<url:string,original_url:boolean>>",
    )
    expanded = media.expansions(
        domains(spark),
        spark.createDataFrame([("http://s.co/p", 301, "http://x/p.png")], URLS),
    )
    sizes = spark.createDataFrame(probes, PROBES)
    return enrichment.links_and_images(drops, expanded, sizes, **options).first()


def test_images_by_area_first_of_equals_and_copies(spark):
    raw = (
        '<img src="a"><img src="b"><img src="c"><img src="b"><img src="d">'
        '<img src="gone">'
    )
    drop = enriched(
        spark, raw,
        [("a", 100, 50), ("b", 100, 100), ("c", 100, 100), ("d", 5001, 1)],
    )
    assert [(m["url"], m["droplet_image"]) for m in drop["media"]] == [
        ("b", True), ("c", False), ("b", True), ("d", False),
    ]
    assert drop["media_complete"] and drop["source"] == "mediaextractor"
    assert drop["links"] is None


def test_links_in_order_and_expanded_before_classing(spark):
    raw = '<a href="http://x/1">1</a> http://s.co/p <a href="http://x/2">2</a>'
    drop = enriched(spark, raw, [("http://x/p.png", 200, 200)])
    assert [x["url"] for x in drop["links"]] == ["http://x/1", "http://x/2"]
    assert [m["url"] for m in drop["media"]] == ["http://x/p.png"]


def test_own_links_stay_unless_merged(spark):
    raw = '<a href="http://x/1">1</a><a href="own">2</a>'
    own = [("own", True)]
    kept = enriched(spark, raw, [], own)
    assert [x["url"] for x in kept["links"]] == ["own"]
    merged = enriched(spark, raw, [], own, merge_links=True)
    assert [x["url"] for x in merged["links"]] == ["own", "http://x/1"]


def test_empty_content_yields_nothing_but_the_stamp(spark):
    drop = enriched(spark, "", [])
    assert drop["media"] is None and drop["links"] is None and drop["media_complete"]


def answered(spark, body, raw="text", status=200, complete=None):
    drops = spark.createDataFrame(
        [("1", raw, complete)],
        "correlation_id string, droplet_raw string, semantics_complete boolean",
    )
    attempts = spark.createDataFrame(
        [("1", 1, status, body)],
        "correlation_id string, attempt int, status int, body string",
    )
    return enrichment.tags_and_places(drops, attempts).first()


def test_empty_places_and_tags_are_not_missing(spark):
    drop = answered(spark, '{"places":[]}')
    assert drop["places"] == [] and drop["tags"] == []
    assert answered(spark, '{"x":["a"]}')["places"] is None


def test_tags_and_places(spark):
    drop = answered(
        spark,
        '{"person":["a","b"],"places":[{"name":"n","latitude":1.5,'
        '"longitude":2,"place_type":"t"}],"org":["c"]}',
    )
    assert sorted(map(tuple, drop["tags"])) == [
        ("org", "c"), ("person", "a"), ("person", "b"),
    ]
    assert tuple(drop["places"][0]) == ("n", 1.5, 2.0, "t", "gisgraphy")


def test_no_raw_text_already_complete_or_failed(spark):
    body = '{"x":["a"]}'
    for drop in (
        answered(spark, body, raw=None),
        answered(spark, body, complete=True),
        answered(spark, body, status=500),
        answered(spark, ""),
    ):
        assert drop["tags"] is None and drop["semantics_complete"]
        assert drop["source"] == "semantics"


def test_attempts_are_given_up_after_the_retries(spark):
    tries = [("a", i, 500, None) for i in range(1, 6)] + [("a", 6, 200, "x")]
    tries += [("b", i, 500, None) for i in range(1, 7)] + [("b", 7, 200, "x")]
    attempts = spark.createDataFrame(
        tries, "correlation_id string, attempt int, status int, body string"
    )
    got = {r["correlation_id"]: r["body"] for r in entities.accept(attempts).collect()}
    assert got == {"a": "x", "b": None}


def test_extraction_keeps_order_over_kinds(spark):
    raw = '<IMG src="i"> http://t/ <a href="a">'
    drops = spark.createDataFrame([(1, raw)], "id bigint, droplet_raw string")
    found = media.extract_urls(drops.withColumn("droplet_content", F.lit("x")))
    got = [(r["tag"], r["url"]) for r in found.orderBy("pos").collect()]
    assert got == [("img", "i"), ("a", "a"), ("text", "http://t/")]


def test_large_captures_resolve_as_small_ones(spark, monkeypatch):
    chain = [(f"http://s.co/{i}", 301, f"http://s.co/{i + 1}") for i in range(8)]
    chain += [(f"http://s.co/x{i}", 301, "http://s.co/3") for i in range(9)]
    want = expand(spark, chain)
    monkeypatch.setattr(media.scale, "is_small", lambda *a, **k: False)
    assert expand(spark, chain) == want
    assert want["http://s.co/x1"] == "http://s.co/7"
    raw = '<img src="b"> http://s.co/p <a href="http://x/1">1</a>'
    drop = enriched(spark, raw, [("b", 100, 100), ("http://x/p.png", 200, 200)])
    assert [m["droplet_image"] for m in drop["media"]] == [False, True]
    assert [x["url"] for x in drop["links"]] == ["http://x/1"]
