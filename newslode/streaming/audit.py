"""The audit log as a stream, and what a daily batch has in the place of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "stage string, ts string, run_id string, source_name string, url string, title string, unique_key string, reason string, score int, accepted boolean, rows_total int, created_count int, skipped_count int"


def replay(spark: SparkSession, path: str) -> DataFrame:
    """Audit lines as a stream with ts as event time; stages nobody knows pass."""
    return spark.readStream.schema(EVENT).json(path).withColumn("ts", F.try_to_timestamp("ts"))


def daily(events: DataFrame, ts: str = "ts", *keys: str) -> DataFrame:
    """Counts of each day (and keys); with a watermark upstream the same plan runs over a stream."""
    w = F.window(ts, "1 day")
    return events.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), *keys, "n")


def dedup_stream(events: DataFrame, key: str, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, user: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    w = F.session_window(ts, gap)
    return events.groupBy(w.alias("w"), user).agg(F.count("*").alias("n")).select(user, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


def rate_gaps(requests: DataFrame, seconds: float) -> DataFrame:
    """Requests that came sooner after the one before on their host than the limit allows."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("host").orderBy("ts")
    gap = F.col("ts").cast("double") - F.lag("ts").over(w).cast("double")
    return requests.withColumn("gap", gap).where(F.col("gap") < seconds)
