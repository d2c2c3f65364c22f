"""The five governed marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.money import ratio, with_revenue_ladder

# Daily sums: mart column -> order-grain column.
LADDER_SUMS = {
    "gmv": "gmv_amount",
    "gross_revenue": "gross_amount",
    "net_revenue": "net_amount",
    "recognized_revenue": "recognized_amount",
    "refunds": "refund_amount",
    "net_margin": "net_margin_amount",
}


def fct_orders(orders_enriched: DataFrame) -> DataFrame:
    """Order fact, the source of truth for order counts."""
    return orders_enriched.drop("gender", "num_of_item").select(
        "order_id", "user_id", "order_date", "created_at", "status",
        "is_net_order", "is_returned", "is_cancelled", "item_count",
        *LADDER_SUMS.values(),
        "shipped_at", "delivered_at", "returned_at",
    )


def dim_customers(
    users: DataFrame, orders: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Customers with lifetime order behaviour; ``as_of`` ignores orders from that day on."""
    if as_of is not None:
        orders = orders.filter(F.col("order_date") < F.lit(as_of))
    net_day = F.when(F.col("is_net_order"), F.col("order_date"))
    lifetime = orders.groupBy("user_id").agg(
        F.count_if("is_net_order").alias("n_net"),
        F.sum("net_amount").alias("net_total"),
        F.min(net_day).alias("first_order_date"),
        F.max(net_day).alias("most_recent_order_date"),
    )
    n_net = F.coalesce(F.col("n_net"), F.lit(0))
    segment = (
        F.when(n_net == 0, F.lit("never_purchased"))
        .when(n_net == 1, F.lit("one_time"))
        .otherwise(F.lit("repeat"))
    )
    return users.join(lifetime, "user_id", "left").select(
        "user_id", "first_name", "last_name", "email", "age", "gender", "city", "state",
        "country", "traffic_source", F.col("created_at").alias("signed_up_at"),
        n_net.alias("lifetime_net_orders"),
        F.coalesce(F.col("net_total"), F.lit(0.0)).alias("lifetime_net_revenue"),
        "first_order_date", "most_recent_order_date",
        (n_net >= 2).alias("is_repeat_customer"),
        segment.alias("customer_segment"),
    )


def dim_products(products: DataFrame, items: DataFrame) -> DataFrame:
    """Catalogue with lifetime sales.

    Lines are reduced per product before they meet the catalogue, so a best-seller costs one
    combined row per map task and no line is joined. Cost is constant within a product, so the
    margin of its net lines is their revenue less cost times their number.
    """
    sold = with_revenue_ladder(items).groupBy("product_id").agg(
        F.count_if("is_net").alias("units"),
        F.count(F.when(F.col("is_net"), F.col("sale_price"))).alias("priced_units"),
        F.sum("net_amount").alias("net_total"),
        F.sum("refund_amount").alias("refund_total"),
    )
    margin = F.col("net_total") - F.col("cost") * F.col("priced_units")
    return products.join(sold, "product_id", "left").select(
        *products.columns,
        F.coalesce(F.col("units"), F.lit(0)).alias("units_sold_net"),
        F.coalesce(F.col("net_total"), F.lit(0.0)).alias("net_revenue"),
        F.coalesce(margin, F.lit(0.0)).alias("net_margin"),
        F.coalesce(F.col("refund_total"), F.lit(0.0)).alias("refunds"),
    )


def _additive_kpis():
    return [
        F.count("*").alias("total_orders"),
        F.count_if("is_net_order").alias("net_orders"),
        *[F.sum(source).alias(target) for target, source in LADDER_SUMS.items()],
    ]


def kpi_aggregates():
    """Aggregates shared by the daily mart and the per-period metrics."""
    buyer = F.when(F.col("is_net_order"), F.col("user_id"))
    return [*_additive_kpis(), F.count_distinct(buyer).alias("active_customers")]


def kpi_ratios() -> dict:
    """Ratios of period totals, NULL where the denominator is not positive."""
    return {
        "aov": ratio(F.col("net_revenue"), F.col("net_orders")),
        "refund_rate": ratio(F.col("refunds"), F.col("gross_revenue")),
        "net_margin_rate": ratio(F.col("net_margin"), F.col("net_revenue")),
    }


DAILY_COLUMNS = ("order_date", "total_orders", "net_orders", "active_customers",
                 *LADDER_SUMS, "aov", "refund_rate", "net_margin_rate")


def fct_daily_kpis(orders: DataFrame) -> DataFrame:
    """Headline KPIs, one row per UTC day that has orders.

    Counting distinct customers beside the sums would make every sum travel with each (day,
    customer) pair. The pairs are shuffled on their own, from the order headers alone, and the sums
    leave each task combined to one row per day.
    """
    customers = (
        orders.filter("is_net_order").select("order_date", "user_id").distinct()
        .groupBy("order_date").agg(F.count("user_id").alias("active_customers"))
    )
    stacked = orders.groupBy("order_date").agg(*_additive_kpis()).unionByName(
        customers, allowMissingColumns=True)
    daily = stacked.groupBy("order_date").agg(
        *[F.sum(c).alias(c) for c in stacked.columns if c != "order_date"]
    ).withColumn("active_customers", F.coalesce("active_customers", F.lit(0)))
    return daily.withColumns(kpi_ratios()).select(*DAILY_COLUMNS)


def fct_revenue_recognition(orders: DataFrame) -> DataFrame:
    """Accrual view: recognized plus deferred ties back to management net revenue."""
    per_day = orders.groupBy("order_date").agg(
        F.sum("recognized_amount").alias("recognized_revenue"),
        F.sum("net_amount").alias("net_revenue_mgmt"),
        F.sum("refund_amount").alias("refunds"),
        F.sum("gross_amount").alias("gross_revenue"),
    )
    deferred = F.col("net_revenue_mgmt") - F.col("recognized_revenue")
    return per_day.select(
        "order_date", "recognized_revenue", deferred.alias("processing_deferred"),
        "net_revenue_mgmt", "refunds", "gross_revenue",
        (F.col("recognized_revenue") + deferred).alias("recon_check"),
    )
