"""Streams of raw records or events: windowed aggregates, late duplicates, running state, upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def events(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files of a folder as a stream, one file a trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def tumbling(stream: DataFrame, time: str, length: str, late: str, keys: list[str], value: str) -> DataFrame:
    """Counts and sums by tumbling window; rows later than the watermark are dropped, as late data must be."""
    timed = stream.withColumn("_ts", F.col(time).cast("timestamp")).withWatermark("_ts", late)
    by = timed.groupBy(F.window("_ts", length), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return by.select(F.col("window.start").alias("start"), *keys, "n", "total")


def deduplicate(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """The first row of each key within the watermark."""
    timed = stream.withColumn("_ts", F.col(time).cast("timestamp")).withWatermark("_ts", late)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_ts")


def run_lengths(stream: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Per row the entity's month counter and how long its value has not changed, carried across batches."""
    kind = dict(stream.dtypes)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, run, count = state.get if state.exists else (None, 0, 0)
        rows = pd.concat(list(batches)).sort_values(order, kind="mergesort")
        runs, counts = [], []
        for v in rows[value].astype(float):
            run = run + 1 if last is not None and abs(v - last) < 0.01 else 0
            last = v
            runs.append(run)
            counts.append(count)
            count += 1
        state.update((last, run, count))
        yield pd.DataFrame({key: k[0], order: rows[order].to_numpy(), "month_index": counts, "unchanged": runs})

    return stream.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind[key]}, {order} {kind[order]}, month_index int, unchanged int", "last double, run int, n int", "append", GroupStateTimeout.NoTimeout)


def upsert(path: str, keys: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: each batch's newest row by key lands in its own folder, so a repeated batch
    replaces itself; ``current`` reads the newest of all."""
    def put(batch: DataFrame, number: int) -> None:
        rest = [c for c in batch.columns if c not in keys]
        newest = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*")
        newest.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return put


def current(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "batch")).alias("_r")).select(*keys, "_r.*")
