"""Streaming forms: new files of events as sessions and windows, late events bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema, files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def sessions(events: DataFrame, gap: str = "2 hours", late: str = "1 day") -> DataFrame:
    """(user_id, session_start, session_end, n, total): events of a user at most `gap` apart. ts may lack a zone; it is read in the session's."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n", "total")


def rates(events: DataFrame, size: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(event_type, start, n, total) of tumbling windows."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if e.isStreaming:
        e = e.withWatermark("ts", late)
    g = e.groupBy("event_type", F.window("ts", size).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select("event_type", F.col("w.start").alias("start"), "n", "total")
