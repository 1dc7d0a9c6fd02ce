"""The queries of this package's operators over their whole tables."""

import public_tokenizers
from pyspark.sql import functions as F

from tributary.llm import (
    ann,
    bpe,
    classifier,
    dedup,
    language,
    lm,
    ordering,
    packing,
    phrases,
    pii,
    quality,
    repair,
    tables,
    toxicity,
)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _remainder(n):
    """Which of ``n`` folds a document is in."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_training_order(spark, sf_dir):
    """Every sequence of the shuffled corpus, with its slot and place."""
    return ordering.materialise(tables.read(spark, sf_dir, "documents"), VOCABULARY)


def op2_near_duplicates(spark, sf_dir):
    """Every document with the class of near copies that it belongs to."""
    return dedup.near_duplicates(tables.read(spark, sf_dir, "documents"))


def op3_bpe(spark, sf_dir):
    """Every text encoded and decoded, as digests."""
    docs = tables.documents(tables.read(spark, sf_dir, "documents"))
    return bpe.digests(docs, VOCABULARY)


def op4_quality_rules(spark, sf_dir):
    """Every document's counts, and whether the rules keep it."""
    return quality.judged(tables.read(spark, sf_dir, "documents"))


def op5_personal_data(spark, sf_dir):
    """Every document's spans of personal data."""
    docs = tables.documents(tables.read(spark, sf_dir, "documents"))
    held = pii.found(docs).select("doc_id", "pii")
    base = F.filter("pii", lambda s: s.rank < len(pii.BASE))
    # A second parameter of the function would be the element's index.
    counts = (
        F.size(F.filter("pii", lambda s: s.kind == name)).cast("bigint").alias(f"n_{name}")
        for name in pii.BASE
    )
    return held.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("pii")).alias("spans"),
    )


def op6_nearest(spark, sf_dir):
    """The 20 nearest found for every twentieth vector."""
    vectors = tables.read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


def op7_language(spark, sf_dir):
    """Every page's language, learnt from the documents' labels."""
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    pages = language.of_pages(tables.read(spark, sf_dir, "pages"))
    return language.posterior(pages, language.fit(docs))


def op8_quality_classifier(spark, sf_dir):
    """Every document's probability of good quality."""
    docs = tables.read(spark, sf_dir, "documents")
    labels = tables.read(spark, sf_dir, "labels")
    network = classifier.trained(docs, labels, _remainder(4) != 2)
    return classifier.score(docs, network).select(
        "doc_id",
        F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op9_language_model(spark, sf_dir):
    """Every document's log probability, learnt without the held-out fold."""
    return lm.score(tables.read(spark, sf_dir, "documents"), _remainder(7) == 2)


def op10_packing(spark, sf_dir):
    """Every piece of every document, and the sequence that it is packed in."""
    return packing.pack(tables.read(spark, sf_dir, "documents"), VOCABULARY).drop("ids")


def op11_conversation_repair(spark, sf_dir):
    """Every damaged conversation's faults, cheapest edits and repaired text."""
    rows = repair.damaged(tables.read(spark, sf_dir, "conversations"))
    edits = tables.written(repair.audits(rows), "repair-audits")
    shas = repair.digests(repair.repaired(rows, edits)).withColumnRenamed("conv_id", "c")
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    sha = F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return edits.join(shas, same, "left").select(edits.columns + [sha])


def op12_phrases(spark, sf_dir):
    """Each language's best collocations."""
    return phrases.collocations(tables.read(spark, sf_dir, "documents"))


def op13_toxicity(spark, sf_dir):
    """Every document's probability of being toxic."""
    docs = tables.read(spark, sf_dir, "documents")
    labels = tables.read(spark, sf_dir, "labels")
    model = toxicity.trained(docs, labels, _remainder(4) != 2)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


QUERIES = (
    op1_training_order,
    op2_near_duplicates,
    op3_bpe,
    op4_quality_rules,
    op5_personal_data,
    op6_nearest,
    op7_language,
    op8_quality_classifier,
    op9_language_model,
    op10_packing,
    op11_conversation_repair,
    op12_phrases,
    op13_toxicity,
)
