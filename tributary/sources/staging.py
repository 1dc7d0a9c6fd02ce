"""Intermediate tables in the folder the cluster keeps for checkpoints."""

import tempfile
import uuid

#: For tables of long lists: a reader takes up to 4,096 rows of a row group at once, so
#: these are kept small.
LISTS = {"parquet.block.size": str(16 << 20)}


def shared_folder(spark, name):
    """A new folder for ``name`` where the cluster keeps checkpoints.

    Only a session whose tasks all run on this machine gets a local one if it
    names no such place; elsewhere that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="tributary-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df, name, options=None):
    """``df`` as a table written once and read back.

    Used where a narrow result of heavy work is read several times: the work is
    done once, a lost executor costs a task and not the lineage, and later
    steps prune columns.  Folders are left to the cluster's clean-up rule.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
