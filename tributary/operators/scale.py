"""Plan-shaping helpers: checked broadcasts, hot keys, bounded array parts."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a side may hold to be broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

#: A key is hot when it holds more than 1/HOT_KEYS of the rows, so there can
#: be at most HOT_KEYS of them, whatever the size of the data.
HOT_KEYS = 1000
TRACKED = 10_000

#: Rows of a hot key that one task should get.
TASK_ROWS = 1_000_000

#: About how many ids one array of an output row may hold.
PART_SPAN = 10_000

#: Bytes of lists that a file holds once each in whatever order its rows come, and
#: rows that stand behind one copy of a list beyond that.
LIST_BYTES = 1 << 20
LIST_ROWS = 16_384

#: Bytes of lists that a task of ``dealt_lists`` should meet, so few that a file keeps
#: each once even where several tasks' lists fall together; and tasks at most.
TASK_LIST_BYTES = LIST_BYTES // 8
LIST_TASKS = 4096


def _row_bytes(schema):
    """About how many bytes a row takes."""
    total = F.lit(0).cast("bigint")
    for field in schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.coalesce(F.octet_length(column), F.lit(0)) + 16
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.AtomicType):
            size = F.greatest(F.size(column), F.lit(0)) * 32 + 16
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            # What is nested is measured by its text.
            size = F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) + 16
        else:
            size = F.lit(16)
        total = total + size.cast("bigint")
    return total


def is_small(df, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES):
    """Measure ``df`` (rows and bytes, one distributed aggregate)."""
    rows, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df.schema))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df, max_rows=BROADCAST_ROWS, max_bytes=BROADCAST_BYTES):
    """Broadcast ``df`` if it was measured to be small, else leave it alone.

    Past the bound the join is left to Catalyst, which shuffles both sides and
    lets AQE split skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def hot_keys(df, key, min_rows=100_000, count=None):
    """Keys holding more than 1/HOT_KEYS of the rows: column ``key``, and their
    number of rows by the sketch in a column named ``count``, if asked for.

    One pass with a mergeable sketch of frequent items, so only the sketches
    are shuffled.  The result is at most HOT_KEYS rows by arithmetic.  A key
    missed or added by the sketch changes the spread of the work, never rows.
    """
    tops = (
        df.where(F.col(key).isNotNull())
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED})").alias("tops"),
        )
        .select("n", F.inline("tops"))
    )
    heavy = (F.col("count") * HOT_KEYS > F.col("n")) & (F.col("count") >= min_rows)
    columns = [F.col("item").alias(key)]
    if count:
        columns.append(F.col("count").alias(count))
    return tops.where(heavy).select(*columns)


def skew_join(
    left,
    right,
    key,
    how="inner",
    spread_by=None,
    spread=8,
    min_rows=100_000,
    small=None,
):
    """Equi-join of a large ``left`` that may have hot keys.

    A ``right`` measured to be small is broadcast.  Otherwise both sides are
    shuffled, hot rows of ``left`` are salted over as many tasks as give each about
    ``TASK_ROWS`` (``spread`` at least), and only the matching rows of ``right`` are
    repeated.  ``left`` should be cheap to scan
    twice (a stored table, or CPU work alone).  The salt is a hash of
    ``spread_by``, so a task that is run again gives the same rows.  ``small``
    passes on a measurement of ``right`` made before.
    """
    if is_small(right) if small is None else small:
        return left.join(F.broadcast(right), key, how)
    parts = F.greatest(F.lit(spread), F.ceil(F.col("_rows") / TASK_ROWS))
    hot = hot_keys(left, key, min_rows, "_rows").select(
        key, parts.cast("bigint").alias("_parts")
    )
    hot = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    salt = F.pmod(F.xxhash64(*(spread_by or left.columns)), parts)
    spread_left = left.join(hot, key, "left").withColumn("_salt", salt)
    copies = F.sequence(F.lit(0).cast("bigint"), parts - 1)
    spread_right = right.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    joined = spread_left.drop("_parts").join(
        spread_right.drop("_parts"), [key, "_salt"], how
    )
    return joined.drop("_salt")


def beside_lists(rows, lists, key, spread_by):
    """Equi-join of ``rows`` with ``lists``, wide rows that many rows share.

    Lists that are few bytes all together are broadcast.  Otherwise rows of one
    list come out one behind the other, so that a file that keeps equal values
    once (Parquet) holds a list once and not once per row: the lists lead the merge,
    and a list with very many rows is repeated for each ``LIST_ROWS`` of them.
    """
    if is_small(lists, max_bytes=LIST_BYTES):
        return rows.join(F.broadcast(lists), key)
    parts = F.ceil(F.col("_rows") / LIST_ROWS).cast("bigint")
    hot = F.broadcast(hot_keys(rows, key, LIST_ROWS, "_rows").select(key, parts.alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    salt = F.pmod(F.xxhash64(*spread_by), parts)
    spread_rows = rows.join(hot, key, "left").withColumn("_salt", salt).drop("_parts")
    copies = F.sequence(F.lit(0).cast("bigint"), parts - 1)
    spread_lists = lists.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_parts")
    return spread_lists.join(spread_rows.hint("merge"), [key, "_salt"]).drop("_salt")


def dealt_lists(rows, lists, key, spread_by, most=LIST_ROWS, small=None):
    """Equi-join of many narrow ``rows`` with ``lists``, wide rows (key, part, ...) that
    many rows share, for results that are written as they come.

    Lists that are few bytes all together are broadcast.  Otherwise rows are repeated for
    the parts of their key *without* the lists, and both sides are dealt by key and part
    over so many tasks that each meets few lists: neither a file nor a task's memory then
    holds a list once per row.  A list with more than ``most`` rows is dealt over several
    tasks.  ``rows`` are read several times and should be stored.
    """
    if is_small(lists, max_bytes=LIST_BYTES) if small is None else small:
        return rows.join(F.broadcast(lists), key)
    spark = rows.sparkSession
    copies = F.ceil(F.col("_rows") / most).cast("bigint")
    hot = hot_keys(rows, key, most, "_rows").select(key, copies.alias("_parts"))
    # At most HOT_KEYS rows, found once.
    hot = F.broadcast(spark.createDataFrame(hot.collect(), hot.schema))
    parts = F.coalesce("_parts", F.lit(1).cast("bigint"))
    # A part that is null is one as well.
    numbered = lists.withColumn("_list", F.xxhash64("part")).join(hot, key, "left")
    size = numbered.agg(F.sum(_row_bytes(lists.schema) * parts)).first()[0] or 0
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(width, min(LIST_TASKS, size // TASK_LIST_BYTES))
    place = [key, "_list", "_copy"]
    salt = F.pmod(F.xxhash64(*spread_by), parts)
    salted = rows.join(hot, key, "left").withColumn("_copy", salt).drop("_parts")
    held = numbered.select(key, "_list").distinct()
    wanted = skew_join(salted, held, key, spread_by=spread_by)
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    repeated = numbered.withColumn("_copy", each).drop("_parts")
    # A number of tasks that is asked for is kept, small tasks are not put together.  Rows
    # lead the merge, as Spark holds in memory all that one leading row gives.
    beside = repeated.repartition(tasks, *place).hint("merge")
    return wanted.repartition(tasks, *place).join(beside, place).drop("_list", "_copy")


def with_part(df, key, id_column, size=None, most=PART_SPAN):
    """``df`` with ``part``, so that arrays collected per (key, part) are bounded.

    The members of each key are counted first, or their ``size`` summed.  A key
    with at most ``most`` has the one part 0; a larger one is dealt by a hash of
    the id over as many parts as keep each at about ``most``.  Only large keys come
    out of the count, so AQE broadcasts them unless they are very many.
    """
    total = F.sum(size if size is not None else F.lit(1))
    names = [f"_k{i}" for i in range(len(key))]
    large = (
        df.groupBy(*(F.col(k).alias(n) for k, n in zip(key, names)))
        .agg(total.alias("_total"))
        .where(F.col("_total") > most)
        .select(*names, F.ceil(F.col("_total") / most).alias("_parts"))
    )
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)]
    digest = F.substring(F.md5(F.col(id_column).cast("string")), 1, 8)
    number = F.conv(digest, 16, 10).cast("bigint")
    part = F.coalesce(F.pmod(number, F.col("_parts")), F.lit(0).cast("bigint"))
    return df.join(large, same, "left").select(*df.columns, part.alias("part"))


def spread_if_few(scanned, key):
    """Spread a table that too few tasks would read over all cores, by ``key``.

    For small inputs of heavy text work only: a table of many splits is left as
    it is.  ``scanned`` must be a scan with narrow steps, so asking for its
    number of partitions runs nothing.
    """
    width = scanned.sparkSession.sparkContext.defaultParallelism
    if scanned.rdd.getNumPartitions() >= width:
        return scanned
    return scanned.repartition(width, key)
