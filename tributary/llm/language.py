"""Language identification by Bayesian fusion of several kinds of evidence.

For each language the log posterior of a text is the sum of

* its text likelihood: byte trigrams, hashed to ``BINS``, under a table per language
  learned from a bounded sample of labelled chunks (``SAMPLE``), divided by three
  since each byte is in three trigrams;
* the declared language: how often texts of that language declare what this one
  declares (smoothed counts over all texts);
* the host: how the texts of its host divide among the languages, smoothed towards
  its address suffix, and that towards all texts.

Counts are sums of text posteriors over all rows, by grouped aggregation, so a host
with most of the rows is summed before it is shuffled.  A row is accepted if its
best language has a posterior of ``ACCEPT`` or more and its text fits that language:
its mean log likelihood a trigram reaches the cutoff of the language for texts of at
least so many trigrams (``LEVELS``).  Cutoffs are low quantiles over sampled chunks,
each under a table learned without it, less half their distance from the median, and
never below the uniform distribution, which stands for all other texts.  Pages
may be in several learnt languages: with ``mixed`` a text also fits if under one table
of all of them it is likelier than uniform.  A text that does not fit is "und" with probability 0; one that fits no language counts for none.

Cases: a null or empty text, or one of fewer than ``LEVELS[0]`` trigrams, is too short
to be held against a cutoff, the other evidence decides.  Null
declaration, host or suffix count as a value of their own.  Repeated rows count
each.  An empty table gives no rows; without any labels all rows are undetermined
("und") and not accepted.  ``accepted_only`` keeps all columns as they were.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tributary.llm import chunks, tables, words
from tributary.operators import scale

SAMPLE, BINS = 12_000, 1 << 15
ACCEPT = 0.5
#: Numbers of trigrams with cutoffs of their own; quantile of a language's own texts
#: below a cutoff, and how many texts it takes (with fewer, the uniform one is it).
LEVELS, LOW, ENOUGH = (32, 64, 128, 256, 510), 0.001, 50
#: Texts that a prior counts for, of a host towards its suffix and so on.
PULL = 5.0
#: Bytes of text whose trigrams are looked up at a time: a row of numbers for each.
SLICE = 1 << 17

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _grams(data):
    low = _LOWER[data].astype(np.uint32)
    key = low[:-2] | low[1:-1] << 8 | low[2:] << 16
    return (key * np.uint32(2654435761)) >> np.uint32(32 - 15)


class Model:
    """Names of the languages, log likelihoods of trigrams, one row per bin, and
    cutoffs, one row per level; the last column is that of all languages together."""

    def __init__(self, names, table, cutoffs=None):
        self.names, self.table, self.cutoffs = names, table, cutoffs

    def likelihoods(self, column, mixed=True):
        """Log likelihoods, a row per text, a column per language; and the same for
        whether the text fits."""
        data, offsets = words.utf8(column)
        made, n = [], np.maximum(np.diff(offsets) - 2, 0)
        for i, j in words.slices(offsets, SLICE):
            text, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            sums = np.zeros((j - i, self.table.shape[1]))
            if len(text) > 2 * SLICE:
                # One long text.  Sums of single-precision numbers are exact in any parts.
                for k in range(0, len(text) - 2, SLICE):
                    sums[0] += self.table[_grams(text[k : k + SLICE + 2])].sum(axis=0, dtype=np.float64)
            elif len(text) > 2:
                total = np.cumsum(self.table[_grams(text)], axis=0, dtype=np.float64)
                total = np.vstack([np.zeros(total.shape[1]), total])
                last = np.maximum(at[1:] - 2, at[:-1])
                sums = total[np.minimum(last, len(total) - 1)] - total[np.minimum(at[:-1], len(total) - 1)]
            made.append(sums / 3)
        made = np.concatenate(made) if made else np.zeros((0, self.table.shape[1]))
        level = np.searchsorted(LEVELS, n, "right") - 1
        fits = 3 * made >= n[:, None] * self.cutoffs[np.maximum(level, 0)]
        k = len(self.names)
        return made[:, :k], fits[:, :k] | (fits[:, k:] & mixed) | (level < 0)[:, None]


def fit(labelled, most=SAMPLE):
    """A model from a bounded sample of ``labelled`` (doc_id, text, lang)."""
    known = labelled.where("lang is not null and lang <> '' and text is not null")
    names = [r.lang for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(256).collect()]
    places = F.create_map(*(F.lit(x) for k, n in enumerate(names) for x in (n, k))) if names else None
    if places is None:
        return Model([], np.zeros((BINS, 1), np.float32))
    known = known.withColumn("label", places[F.col("lang")].cast("int")).where("label is not null")
    held, labels = chunks.sample(known, most)
    # Counts of two halves of the chunks, so that each can be held against the other.
    counts = np.zeros((2, BINS, len(names)))
    grams = [[] for _ in names]
    for k in range(len(names)):
        for i, row in enumerate(held[labels == k]):
            used = row[: int((row != 0).sum())]
            if len(used) > 2:
                grams[k].append((i % 2, _grams(used)))
                counts[i % 2, :, k] += np.bincount(grams[k][-1][1], minlength=BINS)
    # All together: each language counts alike.
    shares = counts / np.maximum(counts.sum(axis=(0, 1)), 1) * counts.sum() / max(len(names), 1)
    counts = np.concatenate([counts, shares.sum(axis=2, keepdims=True)], axis=2)
    cutoffs = np.full((len(LEVELS), len(names) + 1), -np.log(BINS))
    for k, chunks_of in enumerate(grams):
        others = [_logs(counts[1 - half, :, k]) for half in (0, 1)]
        found = [[] for _ in LEVELS]
        for half, keys in chunks_of:
            sums = np.concatenate([[0], np.cumsum(others[half][keys])])
            for means, n in zip(found, LEVELS):
                starts = np.arange(0, len(keys) - n + 1, n)
                means += ((sums[starts + n] - sums[starts]) / n).tolist()
        for level, means in enumerate(found):
            if len(means) >= ENOUGH:
                low, middle = np.quantile(means, [LOW, 0.5])
                cutoffs[level, k] = max(cutoffs[level, k], low - (middle - low) / 2)
    return Model(names, _logs(counts.sum(axis=0)).astype(np.float32), cutoffs)


def _logs(counts):
    """Log likelihoods of smoothed counts, whose columns are languages."""
    smooth = counts + 0.1
    return np.log(smooth / smooth.sum(axis=0))


def _softmax(values):
    """Probabilities of an array of log weights."""
    top = F.array_max(values)
    raised = F.transform(values, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda s, x: s + x)
    return F.transform(raised, lambda x: x / total)


def _sums(k):
    """Sums of the parts of array ``p`` of length ``k``, as an array."""
    return F.array(*(F.sum(F.get("p", F.lit(i))) for i in range(k)))


def posterior(rows, model, mixed=True):
    """``rows`` with what the fusion finds.

    ``rows`` has ``text``, ``declared``, ``host`` and ``suffix``; the result has its
    other columns, these but the text, and ``language``, ``probability``,
    ``text_language``, ``accepted``.
    """
    rest = [c for c in rows.columns if c != "text"]
    if not model.names:
        return rows.select(
            *rest, F.lit("und").alias("language"), F.lit(0.0).alias("probability"),
            F.lit("und").alias("text_language"), F.lit(False).alias("accepted"),
        )
    k = len(model.names)
    held = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("t array<double>, fits array<boolean>")
    def likelihoods(text: pa.Array) -> pa.Array:
        found = held.value.likelihoods(text, mixed)
        ends = pa.array(np.arange(len(text) + 1) * k, pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in found]
        return pa.StructArray.from_arrays(lists, ["t", "fits"])

    seen = rows.withColumn("evidence", likelihoods("text")).drop("text")
    seen = seen.withColumns({c: F.col(f"evidence.{c}") for c in ("t", "fits")}).drop("evidence")
    seen = seen.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("declared", "host", "suffix")})
    some = F.exists("fits", lambda x: x)
    nothing = F.array(*[F.lit(0.0)] * k)
    seen = seen.withColumn("p", F.when(some, _softmax(F.col("t"))).otherwise(nothing))
    seen = tables.written(seen, "language-evidence")

    hosts = seen.groupBy("suffix", "host").agg(_sums(k).alias("p"))
    hosts = tables.written(hosts, "language-hosts")
    suffixes = hosts.groupBy("suffix").agg(_sums(k).alias("s"))
    everything = hosts.agg(_sums(k).alias("p")).first().p or [0.0] * k
    total = sum(x or 0.0 for x in everything) + k
    whole = F.array(*(F.lit(((x or 0.0) + 1) / total) for x in everything))

    def smoothed(counts, prior):
        n = F.aggregate(counts, F.lit(PULL), lambda s, x: s + x)
        return F.zip_with(counts, prior, lambda c, q: (c + PULL * q) / n)

    priors = hosts.join(suffixes, "suffix").select(
        "suffix", "host", smoothed(F.col("p"), smoothed(F.col("s"), whole)).alias("prior")
    )
    declared = seen.groupBy("declared").agg(_sums(k).alias("p"))
    declared = declared.select(
        "declared", F.zip_with("p", F.array(*(F.lit((x or 0.0) + 1) for x in everything)),
                               lambda c, n: F.log((c + 0.1) / n)).alias("said")
    )
    placed = seen.withColumn("place", F.struct("suffix", "host")).join(
        scale.broadcast_if_small(tables.written(declared, "language-declared")), "declared"
    )
    priors = tables.written(priors, "language-priors")
    if scale.is_small(priors):
        placed = placed.join(F.broadcast(priors), ["suffix", "host"])
    else:
        keyed = priors.withColumn("place", F.to_json(F.struct("suffix", "host"))).drop("suffix", "host")
        placed = scale.skew_join(placed.withColumn("place", F.to_json("place")), keyed, "place", small=False)
    fused = F.zip_with(F.zip_with("t", "said", lambda a, b: a + b), "prior", lambda a, b: a + F.log(b))
    names = F.array(*(F.lit(x) for x in model.names))
    placed = placed.withColumn("q", _softmax(fused))
    best = F.array_max("q")
    at = (F.array_position("q", best) - 1).cast("int")
    fits = F.get("fits", at)
    text_at = (F.array_position("p", F.array_max("p")) - 1).cast("int")
    return placed.select(
        *rest,
        F.when(fits, F.get(names, at)).otherwise("und").alias("language"),
        F.when(fits, best).otherwise(0.0).alias("probability"),
        F.when(F.exists("fits", lambda x: x), F.get(names, text_at)).otherwise("und").alias("text_language"),
        ((best >= ACCEPT) & fits).alias("accepted"),
    )


# What holds no running text in a page, and where it says its language.
_NO_TEXT = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>"
_LANG = r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})"""


def of_pages(pages):
    """The evidence that raw pages hold: text, declared language, host and suffix."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.regexp_replace(html, _NO_TEXT, " ").alias("text"),
        F.lower(F.regexp_extract(html, _LANG, 1)).alias("declared"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"),
    )


def accepted_only(docs, model, declared="lang", host="source"):
    """The rows of ``docs`` whose language is determined, with all their columns."""
    kept, = tables.fresh(docs, "kept_")
    rows = docs.select(
        F.struct(*(f"`{c}`" for c in docs.columns)).alias(kept),
        F.col("text").cast("string").alias("text"),
        F.col(f"`{declared}`").alias("declared"),
        F.col(f"`{host}`").alias("host"),
        F.lit("").alias("suffix"),
    )
    return posterior(rows, model, mixed=False).where("accepted").select(f"{kept}.*")
