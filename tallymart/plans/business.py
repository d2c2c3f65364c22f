"""Governed business questions and dashboard feeds. Every function reads marts only."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.money import dollars
from tallymart.functions.timestamps import month_of


def _nullif_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL on a zero denominator."""
    return F.try_divide(numerator, denominator)


def headline_kpis(daily: DataFrame) -> DataFrame:
    sums = daily.agg(
        *[F.sum(c).alias(c) for c in ("net_revenue", "recognized_revenue", "gmv", "net_orders",
                                      "refunds", "gross_revenue")]
    )
    return sums.select(
        *[dollars(F.col(c)).alias(c) for c in ("net_revenue", "recognized_revenue", "gmv")],
        "net_orders",
        F.round(_nullif_ratio(F.col("net_revenue"), F.col("net_orders")), 2).alias("aov"),
        F.round(_nullif_ratio(F.col("refunds"), F.col("gross_revenue")), 4).alias("refund_rate"),
    )


def monthly_revenue_trend(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy(month_of(F.col("order_date")).alias("month"))
        .agg(
            dollars(F.sum("net_revenue")).alias("net_revenue"),
            dollars(F.sum("recognized_revenue")).alias("recognized_revenue"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def monthly_recognition(recognition: DataFrame) -> DataFrame:
    return (
        recognition.groupBy(month_of(F.col("order_date")).alias("month"))
        .agg(
            dollars(F.sum("recognized_revenue")).alias("recognized"),
            dollars(F.sum("processing_deferred")).alias("deferred_processing"),
            dollars(F.sum("refunds")).alias("refunds"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def revenue_by(
    mart: DataFrame,
    dim: str,
    amount: str = "net_revenue",
    top: int | None = None,
    keep_null: bool = False,
) -> DataFrame:
    """Revenue by one attribute, highest first; ties break on the attribute.

    With ``top`` Spark keeps a bounded heap per task instead of sorting everything.
    """
    known = mart if keep_null else mart.filter(F.col(dim).isNotNull())
    ranked = (
        known.groupBy(dim)
        .agg(dollars(F.sum(amount)).alias("net_revenue"))
        .orderBy(F.desc("net_revenue"), F.asc_nulls_last(dim))
    )
    return ranked.limit(top) if top else ranked


def revenue_by_category(products: DataFrame) -> DataFrame:
    return revenue_by(products, "category", keep_null=True)


def top_categories(products: DataFrame) -> DataFrame:
    return revenue_by(products, "category", top=12)


def revenue_by_department(products: DataFrame) -> DataFrame:
    return revenue_by(products, "department")


def top_brands(products: DataFrame) -> DataFrame:
    return revenue_by(products, "brand", top=10)


def revenue_by_traffic_source(customers: DataFrame) -> DataFrame:
    return revenue_by(customers, "traffic_source", amount="lifetime_net_revenue")


def repeat_purchase_rate(customers: DataFrame) -> DataFrame:
    counts = customers.agg(
        F.count_if(F.col("lifetime_net_orders") >= 1).alias("purchasers"),
        F.count_if("is_repeat_customer").alias("repeat_customers"),
    )
    share = _nullif_ratio(F.col("repeat_customers"), F.col("purchasers"))
    return counts.withColumn("repeat_rate", F.round(share, 3))


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status")
        .agg(F.count("*").alias("orders"))
        .orderBy(F.desc("orders"), F.asc_nulls_last("status"))
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(
        F.count("*").alias("customers"),
        F.sum("lifetime_net_orders").alias("net_orders"),
        F.sum("lifetime_net_revenue").alias("net_revenue"),
    )


def top_customers_ltv(customers: DataFrame, top: int = 50) -> DataFrame:
    """Highest lifetime revenue; equal revenue ranks by customer id."""
    return (
        customers.withColumn("ltv", dollars(F.col("lifetime_net_revenue"), 2))
        .select("user_id", "city", "state", "lifetime_net_orders", "ltv")
        .orderBy(F.desc("ltv"), F.asc_nulls_last("user_id"))
        .limit(top)
    )


def dashboard_kpis(daily: DataFrame, customers: DataFrame) -> DataFrame:
    """The card row of the dashboard: one row, ratios 0 where there is nothing to divide by."""
    totals = daily.agg(
        *[F.sum(c).alias(c) for c in ("net_revenue", "gmv", "recognized_revenue", "refunds",
                                      "gross_revenue", "net_margin", "net_orders")],
        F.min("order_date").alias("date_min"),
        F.max("order_date").alias("date_max"),
    )
    people = customers.agg(
        F.count_if(F.col("lifetime_net_orders") >= 1).alias("purchasers"),
        F.count_if("is_repeat_customer").alias("repeaters"),
    )
    # Two one-row frames side by side: stack them and take the only value of each column.
    stacked = totals.unionByName(people, allowMissingColumns=True)
    both = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

    def or_zero(numerator: str, denominator: str) -> Column:
        share = _nullif_ratio(F.col(numerator), F.col(denominator))
        return F.coalesce(share, F.lit(0.0))

    return both.select(
        "net_revenue", "gmv", "recognized_revenue", "refunds", "net_orders",
        or_zero("net_revenue", "net_orders").alias("aov"),
        "purchasers",
        or_zero("repeaters", "purchasers").alias("repeat_rate"),
        or_zero("refunds", "gross_revenue").alias("refund_rate"),
        or_zero("net_margin", "net_revenue").alias("net_margin_rate"),
        F.col("date_min").cast("string").alias("date_min"),
        F.col("date_max").cast("string").alias("date_max"),
    )


def dashboard_monthly(daily: DataFrame, year: int | None = None) -> DataFrame:
    """Monthly series labelled ``yyyy-MM``, for all years or one."""
    days = daily
    if year is not None:
        # A range, unlike year(), can be pushed to the files of the mart.
        first, last = F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31))
        days = daily.filter(F.col("order_date").between(first, last))
    return (
        days.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(
            dollars(F.sum("net_revenue")).alias("net_revenue"),
            dollars(F.sum("recognized_revenue")).alias("recognized_revenue"),
            F.sum("net_orders").alias("net_orders"),
        )
        .orderBy(F.asc_nulls_last("month"))
    )


def dashboard_years(daily: DataFrame) -> DataFrame:
    """The years a reader can filter the monthly series by."""
    return daily.select(F.year("order_date").alias("year")).distinct().orderBy("year")


def dashboard_payload(
    orders: DataFrame, daily: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Every dashboard section as JSON records: ``(section, position, record)``.

    Sections are short by nature (months, top lists, statuses). Positions keep the section order.
    """
    sections = {
        "kpis": dashboard_kpis(daily, customers).withColumn("position", F.lit(1)),
        "monthly": _numbered(dashboard_monthly(daily), F.asc("month")),
        "by_category": _numbered(top_categories(products), F.desc("net_revenue"),
                                 F.asc("category")),
        "by_department": _numbered(revenue_by_department(products), F.desc("net_revenue"),
                                   F.asc("department")),
        "by_traffic": _numbered(revenue_by_traffic_source(customers), F.desc("net_revenue"),
                                F.asc("traffic_source")),
        "top_brands": _numbered(top_brands(products), F.desc("net_revenue"), F.asc("brand")),
        "by_status": _numbered(orders_by_status(orders), F.desc("orders"), F.asc("status")),
    }
    payload = None
    for name, frame in sections.items():
        record = F.to_json(F.struct(*[c for c in frame.columns if c != "position"]))
        rows = frame.select(F.lit(name).alias("section"), "position", record.alias("record"))
        payload = rows if payload is None else payload.unionByName(rows)
    return payload


def _numbered(frame: DataFrame, *order: Column) -> DataFrame:
    return frame.withColumn("position", F.row_number().over(Window.orderBy(*order)))
