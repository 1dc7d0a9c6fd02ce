"""Where the data comes from.  Schemas are given, never inferred."""

from pyspark.sql import functions as F

from tributary import schemas


def table(spark, path, schema=None):
    """SRC-1/2/3/4, SRC-16..21: a parquet table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def short_domains(spark, path):
    """SRC-15: the list of short domains, one a line, matched exactly."""
    lines = spark.read.text(path).select(F.trim("value").alias("domain"))
    return lines.where(F.col("domain") != "").distinct()


def text_lines(spark, path, stream=False, files_per_trigger=None):
    """SRC-6: (value), one message per line, in batch or as a stream (STR-13)."""
    if not stream:
        return spark.read.text(path)
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def raw_mail(spark, path):
    """SRC-7: (mail_id, mailfrom, rcptto, data); a message is bytes, of any
    character set."""
    return table(
        spark,
        path,
        "mail_id bigint, mailfrom string, rcptto array<string>, data binary",
    )


def messages(spark, path, schema, stream=False, files_per_trigger=None):
    """SRC-8..12, SRC-14: (routing_key, correlation_id, reply_to, seq, body) rows
    with ``body`` parsed to ``m``; a body that is no such object gives NULL."""
    envelope = (
        "routing_key string, correlation_id string, reply_to string, "
        "seq bigint, body string"
    )
    reader = (spark.readStream if stream else spark.read).schema(envelope)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(path)
    # Of a body that is cut off, the part before the cut would count as an object.
    fields = f"{schema}, _corrupt string"
    parsed = F.from_json("body", fields, {"columnNameOfCorruptRecord": "_corrupt"})
    whole = F.col("m._corrupt").isNull() & F.col("m").isNotNull()
    rows = rows.withColumn("m", parsed)
    return rows.withColumn("m", F.when(whole, F.col("m").dropFields("_corrupt")))


def fetch_jobs(spark, path, **how):
    """SRC-11."""
    return messages(spark, path, schemas.FETCH_JOB, **how)


def fetch_responses(spark, path, **how):
    """SRC-10."""
    return messages(spark, path, schemas.FETCH_RESPONSE, **how)


def drops(spark, path, **how):
    """SRC-12: drops to enrich, with the envelope that routes the answer."""
    return messages(spark, path, schemas.DROP, **how)


def push_requests(spark, path, **how):
    """SRC-14."""
    return messages(spark, path, schemas.PUSH_REQUEST, **how)


def versions(spark, path):
    """Numbers of the finished snapshots of a versioned table, from directory names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in store.listStatus(place):
        name = status.getPath().getName()
        if name.startswith("version=") and store.exists(
            hadoop.Path(status.getPath(), "_SUCCESS")
        ):
            found.append(int(name.removeprefix("version=")))
    return sorted(found)


def latest_version(spark, path, before=None):
    """SRC-13: the newest snapshot of a versioned table, or the newest before a
    version; no file of another version is opened."""
    found = [v for v in versions(spark, path) if before is None or v < before]
    if not found:
        raise FileNotFoundError(f"{path} has no finished version to read")
    return spark.read.parquet(f"{path}/version={max(found)}")


def expired_versions(spark, path, keep=2):
    """SNK-5: directories of all but the newest ``keep`` snapshots, for the clean-up."""
    return [f"{path}/version={v}" for v in versions(spark, path)[:-keep]]


def broken(rows):
    """STR-14: messages whose body was no such object, as they came."""
    return rows.where(F.col("m").isNull()).drop("m")
