"""What the operators of this package share: tables, ids, column names."""

from pyspark.sql import functions as F

from tributary.sources import staging


def read(spark, sf_dir, name):
    """A table of the test data, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df, name):
    """``df`` written once to the folder all executors share, and read back."""
    return staging.written(df, name)


def documents(df, id_column="doc_id", text_column="text"):
    """Just the id (BIGINT) and the text (STRING) of ``df``, other columns gone."""
    return df.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )


def fresh(df, *names):
    """Names like ``names`` that clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        made.append(name)
    return made
