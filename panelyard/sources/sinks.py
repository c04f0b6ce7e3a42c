"""Sinks: Parquet in one or several branches, CSV with a provenance header, JSON records, reports."""

from __future__ import annotations

import csv
import io
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parquet(df: DataFrame, path: str, by: list[str] = (), mode: str = "append") -> None:
    df.write.mode(mode).option("compression", "snappy").partitionBy(*by).parquet(path)


def branches(parts: dict[str, DataFrame], path: str) -> None:
    """Several outputs beside one another, each with the union of all columns in one order."""
    columns = list(dict.fromkeys(c for df in parts.values() for c in df.columns))
    types = {c: t for df in parts.values() for c, t in df.dtypes}
    for name, df in parts.items():
        df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns]).write.mode("overwrite").parquet(f"{path}/{name}")


def completed(spark, path: str) -> bool:
    """Whether a write to ``path`` ended, by the marker that Spark's committer leaves."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def once(df: DataFrame, path: str) -> bool:
    """Write unless a completed write is there; whether it wrote."""
    if completed(df.sparkSession, path):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def csv_with_header(df: DataFrame, path: str, notes: list[str]) -> int:
    """A single CSV file with ``#`` lines above the header, in any store Spark writes to; rows pass the driver one partition at a time."""
    spark = df.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    text, n = io.StringIO(newline=""), 0
    text.writelines(f"# {x}\n" for x in notes)
    lines = csv.writer(text)
    lines.writerow(df.columns)
    try:
        for row in df.toLocalIterator(prefetchPartitions=False):
            lines.writerow(["" if v is None else v for v in row])
            n += 1
            if text.tell() > 1 << 20:
                out.write(bytearray(text.getvalue().encode()))
                text.seek(0)
                text.truncate()
        out.write(bytearray(text.getvalue().encode()))
    finally:
        out.close()
    return n


def json_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").option("dateFormat", "yyyy-MM-dd").json(path)


def submission_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def markdown(title: str, tables: dict[str, DataFrame], path: str | None = None, limit: int = 200) -> str:
    """A report with a table for each small frame."""
    out = [f"# {title}"]
    for name, df in tables.items():
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in row) + " |" for row in df.limit(limit).collect()]
    text = "\n".join(out) + "\n"
    if path:
        Path(path).write_text(text)
    return text
