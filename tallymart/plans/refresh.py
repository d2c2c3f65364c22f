"""Keeping the order fact and the daily marts up by the periods that a batch touches.

The fact and both daily marts are partitioned by the day, or the month, of the order. A batch brings
new or changed orders with their lines; its periods are the only partitions that are read, merged
with the batch by order key and written anew, and the only ones whose KPIs are computed again. An
order keeps its day (it is the day on which it was placed), so a changed order replaces its old row
in the same partition. Days suit facts of many files a day; below that, months keep the number of
files small.

Partitions are replaced one by one, and merging by key gives the same partition however often it is
done: a refresh that was interrupted is made good by running it again.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.plans import marts
from tallymart.workspace import scratch_dir, side_by_side, write_and_read

DAILY = {"fct_daily_kpis": marts.fct_daily_kpis,
         "fct_revenue_recognition": marts.fct_revenue_recognition}
UNITS = ("day", "month")
PERIOD = "_period"


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/by_period/{table}"


def period(unit: str) -> Column:
    """The partition of a row; orders without a day have one of their own."""
    if unit not in UNITS:
        raise ValueError(unit)
    return F.col("order_date") if unit == "day" else F.trunc("order_date", unit)


def read_by_period(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table that is kept up, with its partition column ``PERIOD`` last."""
    return spark.read.parquet(_path(root, table))


def _replace(frame: DataFrame, root: str, table: str, unit: str) -> None:
    """Write the periods of ``frame``, leaving all others as they are."""
    (frame.withColumn(PERIOD, period(unit)).repartition(PERIOD)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PERIOD)
     .parquet(_path(root, table)))


def _replace_daily(orders: DataFrame, root: str, unit: str) -> None:
    side_by_side(partial(_replace, build(orders), root, table, unit)
                 for table, build in DAILY.items())


def build(orders: DataFrame, root: str, unit: str = "day") -> None:
    """Write the order fact and the daily marts for the first time."""
    _replace(orders, root, "fct_orders", unit)
    written = read_by_period(orders.sparkSession, root, "fct_orders")
    _replace_daily(written.drop(PERIOD), root, unit)


def touched(batch: DataFrame, unit: str) -> list[dt.date | None]:
    """The periods of a batch: at most one per day of the calendar, not one per order."""
    return [r[0] for r in batch.select(period(unit)).distinct().collect()]


def of_periods(frame: DataFrame, periods: list[dt.date | None]) -> DataFrame:
    """The rows of these partitions; no other is read."""
    known = [p for p in periods if p is not None]
    wanted = F.col(PERIOD).isin(known) if known else F.lit(False)
    if len(known) < len(periods):
        wanted = wanted | F.col(PERIOD).isNull()
    return frame.where(wanted)


def refresh(batch: DataFrame, root: str, unit: str = "day") -> list[dt.date | None]:
    """Merge a batch of order facts, replace the periods it touches, and return them.

    ``batch`` has the columns of the order fact, computed from the lines of its orders alone, and
    one row per order. ``unit`` is that of :func:`build`.
    """
    spark = batch.sparkSession
    written = write_and_read(batch, scratch_dir(spark, "refresh/batch"))
    periods = touched(written, unit)
    if not periods:
        return periods
    kept = of_periods(read_by_period(spark, root, "fct_orders"), periods).join(
        written.select("order_id"), "order_id", "left_anti")
    # Written apart first: the partitions that are read here are those that are replaced.
    merged = write_and_read(kept.select(*written.columns).unionByName(written),
                            scratch_dir(spark, "refresh/merged"))
    _replace(merged, root, "fct_orders", unit)
    _replace_daily(merged, root, unit)
    return periods
