"""Streams of events: the same windowed counts as the batch query, with late rows allowed up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def windowed_counts(events: DataFrame, length: str = "1 hour", late: str = "1 day") -> DataFrame:
    """``window_start, event_type, n``: tumbling windows; works on streams and on tables."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")
