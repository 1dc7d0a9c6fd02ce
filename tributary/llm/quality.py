"""Quality rules: a fixed base, and cutoffs that follow each language and source.

Measures of a text become whole numbers (per thousand words or lines, hundredths
of a character).  Per language and source a histogram sketch counts texts by
measure and bin, ``BIN`` wide: its counts add up, so sketches of sources merge to
those of languages and of everything.  A group with fewer than ``ENOUGH`` texts
takes the sketch above it.  The cutoffs are fences outside the quartiles ``a`` and
``b``: ``b + 3 (b - a) + slack``, and for the length of words also the like below.
Texts that fail the base have no part in the sketches.

Cases: a null text has no words and fails.  Null language or source is a group
like any other.  Repeated rows count each.  An empty table gives no rows.  Other
columns may have any name; they are kept by ``kept_only`` and not looked at.
"""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tributary.llm import tables
from tributary.llm.columns import let
from tributary.operators import scale

ENOUGH = 100
BIN = 5

#: What a text may lie outside the fences of its group, in units of the measure;
#: None: no fence on that side.
SLACK = {
    "symbols": (None, 200),
    "stutter": (None, 150),
    "same_lines": (None, 500),
    "word_length": (250, 400),
}

_SPACES = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"


def _covered(windows, width):
    """Positions that lie in a window seen twice or more."""

    def marked(sorted_windows):
        def again(e, i):
            before, after = F.get(sorted_windows, i - 1), F.get(sorted_windows, i + 1)
            return F.coalesce((i > 0) & (before.h == e.h), F.lit(False)) | F.coalesce(
                after.h == e.h, F.lit(False)
            )

        at = F.array_sort(F.transform(F.filter(sorted_windows, again), lambda e: e.i))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            at,
            start,
            lambda s, i: F.struct(
                (s.n + i + width - F.greatest(i, s.end)).cast("bigint").alias("n"),
                (i + width).alias("end"),
            ),
            lambda s: s.n,
        )

    by_hash = F.array_sort(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), let(by_hash, marked)
    ).otherwise(F.lit(0).cast("bigint"))


def measures(text, width=8):
    """A struct of the base counts of ``text`` and of the measures."""
    text = F.coalesce(text, F.lit(""))

    def of(words, lines):
        n = F.size(words).cast("bigint")
        hashes = F.when(
            n >= width,
            F.transform(
                F.sequence(F.lit(1), F.size(words) - (width - 1)),
                lambda i: F.xxhash64(F.slice(words, i, width)),
            ),
        ).otherwise(F.array().cast("array<bigint>"))
        chars = F.aggregate(
            words, F.lit(0).cast("bigint"), lambda s, w: s + F.char_length(w)
        )
        stutter = F.size(
            F.filter(words, lambda w, i: F.coalesce((i > 0) & (F.get(words, i - 1) == w), F.lit(False)))
        )
        return F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            let(hashes, lambda h: _covered(h, width)).alias("n_repeat_words"),
            stutter.cast("bigint").alias("n_stutter"),
            F.size(lines).cast("bigint").alias("n_lines"),
        )

    words = F.filter(F.split(text, _SPACES, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_WORD))
    counts = let(
        F.struct(words.alias("w"), lines.alias("l")), lambda both: of(both.w, both.l)
    )
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("bigint")

    def derived(c):
        def per(x, of):
            return F.when(of > 0, F.floor(x * 1000 / of)).otherwise(F.lit(0)).cast("bigint")

        return F.struct(
            c.c.n_words.alias("n_words"),
            c.c.word_chars.alias("word_chars"),
            c.s.alias("n_symbols"),
            c.c.n_dup_lines.alias("n_dup_lines"),
            c.c.n_repeat_words.alias("n_repeat_words"),
            ((c.c.n_words < 20) | (100 * c.c.n_repeat_words > 30 * c.c.n_words)).alias("base_failed"),
            per(c.s, c.c.n_words).alias("symbols"),
            per(c.c.n_stutter, c.c.n_words).alias("stutter"),
            per(c.c.n_dup_lines, c.c.n_lines).alias("same_lines"),
            F.floor(per(c.c.word_chars, c.c.n_words) / 10).cast("bigint").alias("word_length"),
        )

    return let(F.struct(counts.alias("c"), symbols.alias("s")), derived)


def cutoffs(measured):
    """Fences per group (columns lang, source) from mergeable histogram sketches.

    ``measured`` has ``lang``, ``source`` and the struct ``m``.
    """
    bins = F.explode(
        F.array(*(
            F.struct(F.lit(k).alias("measure"), F.floor(F.col(f"m.{k}") / BIN).alias("bin"))
            for k in SLACK
        ))
    )
    fine = (
        measured.where("not m.base_failed")
        .select("lang", "source", bins.alias("x"))
        .groupBy("lang", "source", "x.measure", "x.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    groups = measured.select("lang", "source").distinct()
    # A sketch per level, the coarser ones merged from the finer.
    by_lang = fine.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    whole = by_lang.groupBy(F.lit(0).alias("one"), "measure", "bin").agg(F.sum("n").alias("n"))
    levels = [
        _fences(fine, ["lang", "source"], "by_own"),
        _fences(by_lang, ["lang"], "of_lang"),
        _fences(whole, ["one"], "of_all"),
    ]
    joined = groups.withColumn("one", F.lit(0))
    for level, keys in zip(levels, (["lang", "source"], ["lang"], ["one"])):
        joined = joined.join(level, keys, "left")
    enough = [F.when(F.col(f"{x}.n") >= ENOUGH, F.col(x)) for x in ("by_own", "of_lang", "of_all")]
    return joined.select("lang", "source", F.coalesce(*enough).alias("fence"))


def _fences(bins, keys, name):
    """One row per group: texts counted, and the fences of every measure."""
    by = W.partitionBy(*keys, "measure")
    placed = bins.withColumn("upto", F.sum("n").over(by.orderBy("bin"))).withColumn(
        "total", F.sum("n").over(by)
    )
    quartiles = placed.groupBy(*keys, "measure").agg(
        F.max("total").alias("n"),
        *(
            F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bin"))).alias(f"q{q}")
            for q in (1, 3)
        ),
    )
    spread = 3 * (F.col("q3") - F.col("q1")) * BIN
    ends = {}
    for measure, (below, above) in SLACK.items():
        mine = F.col("measure") == measure
        if below is not None:
            low = F.col("q1") * BIN - spread - below
            ends[f"{measure}_low"] = F.max(F.when(mine, low))
        ends[f"{measure}_high"] = F.max(F.when(mine, F.col("q3") * BIN + spread + above))
    made = quartiles.groupBy(*keys).agg(
        F.max("n").alias("n"), *(v.alias(k) for k, v in ends.items())
    )
    return made.select(*keys, F.struct("n", *ends).alias(name))


def _verdict(m, fence):
    """Not failed, and within the fences; without fences there is nothing to fail."""
    fine = ~m.base_failed
    for measure, (below, _) in SLACK.items():
        fine &= F.coalesce(m[measure] <= fence[f"{measure}_high"], F.lit(True))
        if below is not None:
            fine &= F.coalesce(m[measure] >= fence[f"{measure}_low"], F.lit(True))
    return fine


def _group(name):
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def judged(docs, lang="lang", source="source"):
    """Per row of ``docs``: doc_id, the base counts, base_failed and kept."""
    measured = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        _group(lang).alias("lang"),
        _group(source).alias("source"),
        measures(F.col("text").cast("string")).alias("m"),
    )
    measured = tables.written(measured, "quality-measures")
    fences = scale.broadcast_if_small(tables.written(cutoffs(measured), "quality-fences"))
    return measured.join(fences, ["lang", "source"]).select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines",
        "m.n_repeat_words", "m.base_failed",
        _verdict(F.col("m"), F.col("fence")).alias("kept"),
    )


def kept_only(docs, lang="lang", source="source"):
    """The rows of ``docs`` that pass, whole and with all their columns."""
    m, x, y, fence = tables.fresh(docs, "m", "lang_", "source_", "fence")
    measured = docs.withColumns({
        m: measures(F.col("text").cast("string")), x: _group(lang), y: _group(source),
    })
    narrow = measured.select(F.col(x).alias("lang"), F.col(y).alias("source"), F.col(m).alias("m"))
    fences = tables.written(cutoffs(tables.written(narrow, "quality-measures")), "quality-fences")
    fences = fences.select(*(F.col(a).alias(b) for a, b in (("lang", x), ("source", y), ("fence", fence))))
    placed = measured.join(scale.broadcast_if_small(fences), [x, y])
    return placed.where(_verdict(F.col(m), F.col(fence))).select(*(f"`{c}`" for c in docs.columns))
