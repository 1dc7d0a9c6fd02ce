"""Numbers of words, and languages whose names end in NUL."""

from tributary.llm import phrases


def test_totals_go_out_when_no_run_waits():
    made = phrases._added([], {"en": 5, "de": 2}).to_pylist()
    assert [(row["fp"], row["lang"], row["f"]) for row in made] == [(None, "en", 5), (None, "de", 2)]


def test_languages_are_told_apart(spark):
    rows = [("a b c", lang) for lang, n in (("en", 3), ("en\0", 5), ("", 4), ("\0", 6)) for _ in range(n)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = phrases.collocations(docs, often=3).collect()
    assert sorted((r.lang, r.phrase, r.a, r.n) for r in found) == [
        ("", "a b c", 4, 12), ("\0", "a b c", 6, 18), ("en", "a b c", 3, 9), ("en\0", "a b c", 5, 15),
    ]
