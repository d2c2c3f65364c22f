"""Event counts per day and type over a stream, with late events bounded by a watermark.

State holds one row per open day and type, whatever the number of events. A day is emitted once,
when the watermark (the latest event time seen before the micro-batch, less the delay) has passed its
end; its state is dropped then. An event whose day was closed that way before its micro-batch began
is late and left out; every other event counts, in whatever order it comes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DELAY = "1 day"
COUNTS = "day date, event_type string, events bigint"


def daily_counts(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """day, event_type and events of a stream (or table) with ``created_at`` and ``event_type``."""
    per_day = (
        events.withColumn("at", F.col("created_at").cast("timestamp"))
        .withWatermark("at", delay)
        .groupBy(F.window("at", "1 day"), "event_type")
        .agg(F.count("*").alias("events")))
    return per_day.select(F.to_date("window.start").alias("day"), "event_type", "events")


def count_new_events(
    spark: SparkSession, events_dir: str, target: str, delay: str = DELAY,
) -> StreamingQuery:
    """Count the Parquet files of staged events that arrived since the last run; returns the query,
    which has ended.

    Closed days are appended to ``target``; open ones stay in the state under its checkpoint, for
    the next run. The file sink lists what it committed, so a repeated micro-batch adds nothing.
    Days are those of the session's time zone, which has to be UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError("days of events are counted in UTC; set spark.sql.session.timeZone")
    events = spark.readStream.schema(
        "event_type string, created_at timestamp_ntz").parquet(events_dir)
    query = (
        daily_counts(events, delay).writeStream.format("parquet").outputMode("append")
        .option("path", f"{target.rstrip('/')}/counts")
        .option("checkpointLocation", f"{target.rstrip('/')}/checkpoint")
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def closed_days(spark: SparkSession, target: str) -> DataFrame:
    """The counts of all days that are closed."""
    return spark.read.schema(COUNTS).parquet(f"{target.rstrip('/')}/counts")
