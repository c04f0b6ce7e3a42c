"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyard.sources.tables import shared_dir

#: White space that separates words, as a Java regular expression.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
#: Bytes of deleted tables from which the shuffles that made them are cleared at once.
WORTH = 8 << 20


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    This cuts the lineage: a lost executor costs the reader nothing but a new
    read, and several consumers do not compute ``df`` again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of ``store`` whose successors are written, and have Spark's cleaner remove shuffles that nothing reads any more.

    The cleaner acts on what the driver's garbage collection finds, so it is asked for, twice, as what
    the first one finds may hold more; small tables are not worth it.
    """
    size = 0
    for df in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        size += files.getContentSummary(path).getLength()
        files.delete(path, True)
    if not tables or size >= WORTH:
        for _ in range(2):
            gc.collect()
            spark._jvm.System.gc()
            time.sleep(0.2)


def words(text: Column) -> Column:
    """The words of a text as an array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
