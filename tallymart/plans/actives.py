"""Distinct customers that add up: exact bitmaps of a day's customers, mergeable over any period.

A bitmap holds the customers of one bucket of ids, 32,768 of them in 4 KB. Days are built once from
the orders; every longer period is the union of its days' bitmaps, of which whole buckets are
shuffled, partially united, instead of customers. Counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("day", "month", "quarter", "year", "all")


def daily_actives(orders: DataFrame) -> DataFrame:
    """order_date, bucket and customers: the customers with a net order on that day.

    Orders without a customer or a day have nobody to count.
    """
    buyers = orders.where(F.col("is_net_order") & F.col("user_id").isNotNull()
                          & F.col("order_date").isNotNull())
    return buyers.groupBy("order_date", F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("customers"))


def _period(grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(grain)
    if grain == "all":
        return F.lit(None).cast("date")
    if grain == "day":
        return F.col("order_date")
    return F.trunc("order_date", grain)


def merged(actives: DataFrame, grain: str) -> DataFrame:
    """period, bucket and customers of a longer period; the result can be merged again."""
    return actives.groupBy(_period(grain).alias("period"), "bucket").agg(
        F.bitmap_or_agg("customers").alias("customers"))


def active_customers(actives: DataFrame, grain: str) -> DataFrame:
    """Distinct customers per period (NULL for all time), from daily bitmaps."""
    counts = merged(actives, grain).groupBy("period").agg(
        F.sum(F.bitmap_count("customers")).alias("active_customers"))
    return counts.select(F.lit(grain).alias("grain"), "period", "active_customers")


def actives_between(actives: DataFrame, first: Column, last: Column) -> DataFrame:
    """Distinct customers from ``first`` to ``last``, both included."""
    return active_customers(actives.where(F.col("order_date").between(first, last)), "all")
