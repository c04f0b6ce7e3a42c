"""Intermediate results that several steps read, in the folder that a session's executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.

    Where the session names none, a session on one machine (tests) gets a temporary one; a cluster must name it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        found = context._jsc.sc().getCheckpointDir()
        if not found.isDefined():
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
            found = context._jsc.sc().getCheckpointDir()
        root = found.get()
    return root.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut by a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
