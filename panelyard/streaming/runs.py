"""Streams over the test tables, run until their input is used up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelyard.sources.tables import shared_dir
from panelyard.streaming import panel


def finish(stream: DataFrame, mode: str = "append", **options) -> DataFrame:
    """Run a stream over what is there now and give its output as a table.

    State and output go to the shared folder.
    """
    spark = stream.sparkSession
    at = f"{shared_dir(spark)}/streams/{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={number}")

    running = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(put).start()
    running.awaitTermination()
    done = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{at}/out")
    if mode == "complete":
        # The last batch holds the whole result.
        last = done.agg(F.max("batch")).first()[0]
        done = done.filter(F.col("batch") == (-1 if last is None else last))
    return done.drop("batch")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = finish(panel.tumbling(_events(spark, sf_dir), "ts", "1 day", "1 day", ["event_type"], "value"), "complete")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def distinct_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _events(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts"))
    return finish(panel.deduplicate(days, "ts", ["user_id", "event_type", "day"], "400 days")).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
