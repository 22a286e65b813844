"""Streaming extension: late and repeated calls, windows, and the latest best per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, one file or a folder, as a stream, its times as timestamps with a watermark."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    # Streams take a single file only by a pattern.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.[p]arquet").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")


def distinct_events(stream: DataFrame, key: str = "event_id") -> DataFrame:
    return stream.dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, keys: list[str], value: str, width: str = "1 day") -> DataFrame:
    return stream.groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def latest_best(stream: DataFrame, keys: list[str]) -> DataFrame:
    """The best value of each key so far, its earliest event on ties; state is one row a key."""
    best = F.max(F.struct("value", (-F.col("event_id")).alias("order"), "event_type"))
    return stream.groupBy(*keys).agg(best.alias("best")).select(*keys, F.col("best.value").alias("value"), F.col("best.event_type").alias("event_type"), (-F.col("best.order")).alias("event_id"))


def drain(result: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream over what is there and give its table."""
    query = result.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return result.sparkSession.table(name)
