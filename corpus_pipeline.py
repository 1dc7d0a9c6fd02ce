"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tributary.llm import dedup, language, packing, pii, quality, queries, tables
from tributary.operators import scale


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base rules and the cutoffs of their group."""
    return quality.kept_only(docs)


def language_id(spark, docs, sf_dir):
    """Documents whose language the evidence determines."""
    return language.accepted_only(docs, language.fit(docs.select("doc_id", "text", "lang")))


def numbered(spark, docs, row):
    """``docs`` with a number in column ``row``, the same ones in each reading.

    Rows of stored Parquet have a place in their file, so their texts are not
    written once more; others are.
    """
    file, at = tables.fresh(docs, "file_", "at_")
    try:
        placed = docs.select(
            "*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at)
        )
    except AnalysisException:
        placed = None
    if placed is not None:
        # One row per file, as in the listing the driver reads them by.
        files = sorted(r[0] for r in placed.select(file).distinct().collect())
        files = spark.createDataFrame(list(enumerate(files)), f"{row} bigint, {file} string")
        number = (F.shiftleft(row, 40) + F.col(at)).alias(row)
        rows = placed.join(F.broadcast(files), file).select(*docs.columns, number)
        # A row that came of another one, as by a join, has no place of its own.
        if rows.groupBy(row).count().where("count > 1").isEmpty():
            return rows
    return tables.written(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")


def near_duplicates(spark, docs, sf_dir):
    """One row, of those with the smallest id, of each class of near copies.

    Rows count each for itself, also those that share an id; rows without id stay.
    """
    row, = tables.fresh(docs, "row_")
    rows = numbered(spark, docs, row)
    known = rows.where("doc_id is not null")
    ids = known.select(F.col(row).alias("r"), F.col("doc_id").cast("bigint").alias("id"))
    placed = dedup.near_duplicates(known.select(F.col(row).alias("doc_id"), "text"))
    placed = placed.select(F.col("doc_id").alias("r"), "component_id").join(ids, "r")
    placed = tables.written(placed, "pipeline-placed")
    first = F.min(F.struct("id", "r")).alias("first")
    classes = placed.groupBy("component_id").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    classes = tables.written(classes.select("component_id", "first.r"), "pipeline-classes")
    members = scale.skew_join(placed, classes.withColumnRenamed("r", "stays"), "component_id")
    gone = members.where("r <> stays").select(F.col("r").alias(row))
    gone = tables.written(gone, "pipeline-copies")
    return rows.join(scale.broadcast_if_small(gone), row, "left_anti").select(docs.columns)


def personal_data(spark, docs, sf_dir):
    """All documents, personal data in their texts masked."""
    masked = pii.redacted(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def packed(spark, docs, sf_dir):
    """Pieces of all documents, packed into sequences."""
    return packing.pack(docs, queries.VOCABULARY)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: SQL can express neither the language model's fusion nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, applied to the documents of ``sf_dir``."""
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
