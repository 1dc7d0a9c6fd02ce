"""Tables kept as a base and changes by key, so that a batch writes what it changes.

    meta/                         key, number of buckets, schema
    base/fold=F/bucket=B/         rows by hash of the first key column
    changes/epoch=E/run=R/batch=N/  changed rows of a batch, ``deleted`` where gone
    folds/fold=F-epoch=E-batch=N/  written last: the changes that fold F holds

A row is read as its last change, else as in the base.  ``fold`` writes the buckets that
changes touch and leaves the others where they are.  An epoch is one checkpoint's
life: a query that starts anew goes on behind its predecessor.  Places are found by
names of directories; no file is opened that the read does not need.
"""

import json
import re

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tributary.operators import scale

BUCKETS = 64


def _children(spark, path):
    """Names within a directory; none if it is not there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(place))


def _value(name):
    return int(name.partition("=")[2])


def _finished(spark, path):
    return "_SUCCESS" in _children(spark, path)


def bucket_of(column, buckets):
    """The bucket of a value of the first key column."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def start(rows, path, key, buckets=BUCKETS):
    """Make ``rows`` the base of a new table."""
    spark = rows.sparkSession
    meta = json.dumps({"key": list(key), "buckets": buckets, "schema": rows.schema.json()})
    spark.range(1).select(F.lit(meta).alias("meta")).write.text(f"{path}/meta")
    _write_base(rows, path, key, buckets, 0)
    _mark(spark, f"{path}/folds/fold=0-epoch=-1-batch=-1")


def _write_base(rows, path, key, buckets, fold):
    dealt = rows.withColumn("bucket", bucket_of(F.col(key[0]), buckets))
    # Files of even size, also where one bucket holds a third of the rows.
    dealt = dealt.hint("rebalance", "bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/base/fold={fold}")


def _mark(spark, path):
    spark.range(0).write.mode("overwrite").parquet(path)


def meta(spark, path):
    """Key columns, number of buckets and schema of the table."""
    held = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return held["key"], held["buckets"], StructType.fromJson(json.loads(held["schema"]))


def epoch_of(spark, path, run):
    """The number of ``run`` among the runs that wrote to the table, a new one the last."""
    epochs = {}
    for name in _children(spark, f"{path}/changes"):
        for inner in _children(spark, f"{path}/changes/{name}"):
            epochs[inner.removeprefix("run=")] = _value(name)
    return epochs.get(run, max(epochs.values(), default=-1) + 1)


def _run(batch):
    """The run that a batch belongs to; batches that no query numbers share one."""
    return getattr(batch, "run", "") or "direct"


def position(spark, path, batch):
    """(epoch, number) of a batch of ``jobs.run`` in this table."""
    return epoch_of(spark, path, _run(batch)), int(batch)


def append(changes, path, batch):
    """Write a batch's changed rows; a repeated batch replaces its own.

    ``changes`` has the table's columns and ``deleted``, each key once.
    """
    epoch, number = position(changes.sparkSession, path, batch)
    inside = f"{path}/changes/epoch={epoch}/run={_run(batch)}/batch={number}"
    changes.write.mode("overwrite").parquet(inside)


def _folds(spark, path):
    """(fold, (epoch, batch)) of the finished folds, the newest last."""
    made = []
    for name in _children(spark, f"{path}/folds"):
        if _finished(spark, f"{path}/folds/{name}"):
            fold, epoch, batch = map(int, re.findall(r"=(-?\d+)", name))
            made.append((fold, (epoch, batch)))
    return sorted(made)


def _batches(spark, path, after, upto):
    """Directories of finished changes behind ``after`` and no later than ``upto``."""
    made = []
    for epoch in _children(spark, f"{path}/changes"):
        for run in _children(spark, f"{path}/changes/{epoch}"):
            inside = f"{path}/changes/{epoch}/{run}"
            for name in _children(spark, inside):
                at = (_value(epoch), _value(name))
                if at > after and (upto is None or at <= upto) and _finished(spark, f"{inside}/{name}"):
                    made.append((at, f"{inside}/{name}"))
    return sorted(made)


def _base_paths(spark, path, last, buckets=None):
    """For each bucket the directory of its newest fold, ``last`` at most."""
    newest = {}
    for name in sorted(_children(spark, f"{path}/base"), key=_value):
        if _value(name) <= last:
            for inner in _children(spark, f"{path}/base/{name}"):
                if inner.startswith("bucket="):
                    newest[_value(inner)] = f"{path}/base/{name}/{inner}"
    return [p for b, p in sorted(newest.items()) if buckets is None or b in buckets]


def _changes(spark, path, schema, after, upto):
    """All changed rows with their epoch and batch, or None where there are none."""
    found = _batches(spark, path, after, upto)
    if not found:
        return None
    wide = StructType([*schema.fields, *StructType.fromDDL("deleted boolean, epoch int, batch int").fields])
    reader = spark.read.schema(wide).option("basePath", f"{path}/changes")
    return reader.parquet(*(place for _, place in found))


def read(spark, path, buckets=None, upto=None, before=None):
    """The table after all finished changes, or up to (epoch, batch) ``upto``.

    ``buckets`` keeps to some buckets of the base, for a read whose keys are known;
    rows of other buckets may then be missing.  ``before`` leaves out that batch.
    """
    key, count, schema = meta(spark, path)
    if before is not None:
        upto = (before[0], before[1] - 1)
    folds = [(f, at) for f, at in _folds(spark, path) if upto is None or at <= upto]
    fold, after = folds[-1]
    paths = _base_paths(spark, path, fold, buckets)
    base = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    names = schema.names
    rows = _changes(spark, path, schema, after, upto)
    if rows is None:
        return base
    if buckets is not None:
        rows = rows.where(bucket_of(F.col(key[0]), count).isin(*buckets))
    values = F.struct(*names, "deleted").alias("v")
    at = F.struct(F.col("epoch"), F.col("batch"))
    last = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max_by(values, at).alias("v"))
    touched = last.select(*[F.col(f"_{k}").alias(k) for k in key])
    kept = base.join(scale.broadcast_if_small(touched), key, "left_anti").select(*names)
    return kept.unionByName(last.where("not v.deleted").select(*[f"v.{n}" for n in names]))


def feed(spark, path, also=""):
    """All changed rows that are still there, with epoch and batch; ``also`` names further
    columns that they were written with (DDL)."""
    _, _, schema = meta(spark, path)
    wide = StructType([*schema.fields, *(StructType.fromDDL(also).fields if also else [])])
    rows = _changes(spark, path, wide, (-2, -2), None)
    if rows is None:
        empty = StructType([*wide.fields, *StructType.fromDDL("deleted boolean, epoch int, batch int").fields])
        return spark.createDataFrame([], empty)
    return rows


def touched_buckets(spark, path, keys):
    """The buckets of the values of the first key column in ``keys``."""
    key, buckets, _ = meta(spark, path)
    return [r[0] for r in keys.select(bucket_of(F.col(key[0]), buckets)).distinct().collect()]


def fold(spark, path):
    """Fold all finished changes into the buckets that they touch; others stay."""
    key, buckets, schema = meta(spark, path)
    last, after = _folds(spark, path)[-1]
    found = _batches(spark, path, after, None)
    if not found:
        return
    upto = found[-1][0]
    rows = _changes(spark, path, schema, after, upto)
    touched = touched_buckets(spark, path, rows)
    _write_base(read(spark, path, touched, upto), path, key, buckets, last + 1)
    # An emptied bucket gives no directory; an empty one hides the older rows.
    made = _children(spark, f"{path}/base/fold={last + 1}")
    for bucket in touched:
        if f"bucket={bucket}" not in made:
            empty = spark.createDataFrame([], schema)
            empty.write.parquet(f"{path}/base/fold={last + 1}/bucket={bucket}")
    _mark(spark, f"{path}/folds/fold={last + 1}-epoch={upto[0]}-batch={upto[1]}")


def expired(spark, path):
    """Directories that a reader of the newest state no longer needs."""
    folds = _folds(spark, path)
    last, after = folds[-1]
    needed = set(_base_paths(spark, path, last))
    old = []
    for name in _children(spark, f"{path}/base"):
        for inner in _children(spark, f"{path}/base/{name}"):
            place = f"{path}/base/{name}/{inner}"
            if inner.startswith("bucket=") and place not in needed:
                old.append(place)
    return old + [p for at, p in _batches(spark, path, (-2, -2), after)]


def mark_common(spark, marks, places):
    """Name the batch that several tables hold by now, by its place in each."""
    name = "-".join(f"epoch={epoch}-batch={batch}" for epoch, batch in places)
    _mark(spark, f"{marks}/{name}")


def common(spark, marks):
    """The newest places that ``mark_common`` named, one for each table."""
    made = []
    for name in _children(spark, marks):
        if _finished(spark, f"{marks}/{name}"):
            numbers = [int(n) for n in re.findall(r"=(-?\d+)", name)]
            made.append(list(zip(numbers[::2], numbers[1::2])))
    return max(made, default=None)
