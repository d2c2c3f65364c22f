"""Metrics for any period and dimension, recomputed from their own grain.

Ratios and distinct counts are never averaged or added up from the daily mart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.money import RECOGNIZED, ratio
from tallymart.functions.timestamps import month_of, period_of
from tallymart.plans.marts import kpi_aggregates, kpi_ratios

# A line in one of these statuses has left the warehouse (fixed values).
SHIPPED_STATUSES = (*RECOGNIZED, "Returned")


def order_kpis(orders: DataFrame, grain: str = "month", dims: Sequence[str] = ()) -> DataFrame:
    """Every KPI of the daily mart for another period and extra order-grain dimensions."""
    return (
        orders.withColumn("period", period_of(F.col("order_date"), grain))
        .groupBy("period", *dims)
        .agg(*kpi_aggregates())
        .withColumns(kpi_ratios())
    )


def line_revenue(lines: DataFrame, grain: str = "all", dims: Sequence[str] = ()) -> DataFrame:
    """The revenue ladder summed at line grain by period and line or product attributes."""
    return (
        lines.withColumn("period", period_of(F.col("order_date"), grain))
        .groupBy("period", *dims)
        .agg(
            F.count("*").alias("line_count"),
            F.count_if("is_gross").alias("gross_lines"),
            F.count_if("is_net").alias("net_lines"),
            F.count_if("is_refund").alias("refund_lines"),
            F.count_if("is_recognized").alias("recognized_lines"),
            F.sum("sale_price").alias("gmv"),
            F.sum("gross_amount").alias("gross_revenue"),
            F.sum("net_amount").alias("net_revenue"),
            F.sum("recognized_amount").alias("recognized_revenue"),
            F.sum("refund_amount").alias("refunds"),
            F.sum("net_margin_amount").alias("net_margin"),
        )
    )


def monthly_aov(orders: DataFrame) -> DataFrame:
    """Net revenue per net order of the month: a ratio of totals, not a mean of daily ratios."""
    return (
        orders.groupBy(month_of(F.col("order_date")).alias("month"))
        .agg(
            F.sum("net_amount").alias("net_revenue"),
            F.count_if("is_net_order").alias("net_orders"),
        )
        .withColumn("aov", ratio(F.col("net_revenue"), F.col("net_orders")))
    )


def monthly_active_customers(orders: DataFrame) -> DataFrame:
    """Distinct customers with a net order in the month."""
    buyer = F.when(F.col("is_net_order"), F.col("user_id"))
    return orders.groupBy(month_of(F.col("order_date")).alias("month")).agg(
        F.count_distinct(buyer).alias("active_customers")
    )


def monthly_repeat_rate(orders: DataFrame) -> DataFrame:
    """Share of a month's active customers with two or more net orders up to that month's end.

    Orders are first reduced to one row per customer and month. The running count then sees at
    most one row per calendar month of history, however many orders a customer has.
    """
    per_month = (
        orders.filter(F.col("is_net_order") & F.col("user_id").isNotNull())
        .groupBy("user_id", month_of(F.col("order_date")).alias("month"))
        .agg(F.count("*").alias("n_orders"))
    )
    so_far = (
        Window.partitionBy("user_id").orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        per_month.withColumn("lifetime_orders", F.sum("n_orders").over(so_far))
        .groupBy("month")
        .agg(
            F.count("*").alias("active_customers"),
            F.count_if(F.col("lifetime_orders") >= 2).alias("repeat_customers"),
        )
        .withColumn("repeat_rate", ratio(F.col("repeat_customers"), F.col("active_customers")))
    )


def category_growth(lines: DataFrame) -> DataFrame:
    """Month-over-month growth of net revenue per category; NULL without a prior month.

    Each monthly total is emitted twice, for its own month and as the prior value of the next
    calendar month, so one grouping pairs them without joining the aggregate to itself. A gap in
    the months gives NULL, as it must, where ``lag`` would reach across it.
    """
    monthly = lines.groupBy("category", month_of(F.col("order_date")).alias("month")).agg(
        F.sum("net_amount").alias("net_revenue")
    )
    this_month = F.struct(
        F.col("month"), F.col("net_revenue").alias("current"),
        F.lit(None).cast("double").alias("prior"), F.lit(1).alias("observed"),
    )
    next_month = F.struct(
        F.add_months("month", 1).alias("month"), F.lit(None).cast("double").alias("current"),
        F.col("net_revenue").alias("prior"), F.lit(0).alias("observed"),
    )
    paired = (
        monthly.filter(F.col("month").isNotNull())
        .select("category", F.inline(F.array(this_month, next_month)))
        .groupBy("category", "month")
        .agg(
            F.max("current").alias("net_revenue"),
            F.max("prior").alias("prior_net_revenue"),
            F.max("observed").alias("observed"),
        )
        .filter("observed = 1")
        .drop("observed")
    )
    return paired.withColumn(
        "growth", ratio(F.col("net_revenue"), F.col("prior_net_revenue")) - 1
    )


def refund_rate_by_count(items: DataFrame) -> DataFrame:
    """Returned lines as a share of the lines that were shipped."""
    return items.agg(
        F.count_if(F.col("status") == "Returned").alias("returned_items"),
        F.count_if(F.col("status").isin(*SHIPPED_STATUSES)).alias("shipped_items"),
    ).withColumn("refund_rate", ratio(F.col("returned_items"), F.col("shipped_items")))


def recognition_by_ship_date(items: DataFrame) -> DataFrame:
    """Recognized revenue by fulfilment day instead of order day; needs no join."""
    return (
        items.filter(F.col("status").isin(*RECOGNIZED) & F.col("shipped_at").isNotNull())
        .groupBy(F.col("shipped_at").cast("date").alias("ship_date"))
        .agg(F.count("*").alias("lines"), F.sum("sale_price").alias("recognized_revenue"))
    )


def revenue_drop_alert(daily: DataFrame, days: int = 28, sigmas: float = 3.0) -> DataFrame:
    """Days whose net revenue lies below mean - ``sigmas`` x stddev of the preceding ``days`` days.

    Each day is sent to itself and to the days it is history for. One grouping then has a day and
    its history together: the series is neither sorted in one task nor computed twice. Missing
    days are simply absent from the history.
    """
    offset, revenue = F.col("offset"), F.col("net_revenue")
    past = F.when(offset > 0, revenue)
    judged = (
        daily.select(
            "order_date", "net_revenue", F.explode(F.sequence(F.lit(0), F.lit(days))).alias("offset")
        )
        .groupBy(F.date_add("order_date", offset).alias("order_date"))
        .agg(
            F.min(offset).alias("nearest"),
            F.max(F.when(offset == 0, revenue)).alias("net_revenue"),
            F.count(past).alias("history_days"),
            F.avg(past).alias("mean_net_revenue"),
            F.stddev_samp(past).alias("stddev_net_revenue"),
        )
        .filter(F.col("nearest") == 0)
    )
    floor = F.col("mean_net_revenue") - F.lit(sigmas) * F.col("stddev_net_revenue")
    return judged.select(
        "order_date", "net_revenue", "history_days", "mean_net_revenue", "stddev_net_revenue",
        F.coalesce(revenue < floor, F.lit(False)).alias("is_drop"),
    )


def event_funnel_daily(events: DataFrame) -> DataFrame:
    """Clickstream traffic per day and event type."""
    return (
        events.groupBy(F.col("created_at").cast("date").alias("event_date"), "event_type")
        .agg(
            F.count("*").alias("events"),
            F.count_distinct("user_id").alias("users"),
            F.count_if(F.col("user_id").isNull()).alias("anonymous_events"),
        )
        .withColumn("anonymous_share", ratio(F.col("anonymous_events"), F.col("events")))
    )


def daily_conversion(events: DataFrame) -> DataFrame:
    """Share of a day's identified users who purchased that day."""
    buyer = F.when(F.col("event_type") == "purchase", F.col("user_id"))
    per_user = events.filter(F.col("user_id").isNotNull()).groupBy(
        F.col("created_at").cast("date").alias("event_date"), "user_id"
    ).agg(F.max(buyer).alias("buyer"))
    return (
        per_user.groupBy("event_date")
        .agg(F.count("*").alias("users"), F.count("buyer").alias("purchasing_users"))
        .withColumn("conversion_rate", ratio(F.col("purchasing_users"), F.col("users")))
    )
