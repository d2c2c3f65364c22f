"""Checks across tables and across columns that the metric contract implies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.quality.checks import union_reports

# Lifecycle timestamp -> statuses in which it must be set; it must be NULL in all others
# (fixed values).
LIFECYCLE = {
    "shipped_at": ("Shipped", "Complete", "Returned"),
    "delivered_at": ("Complete", "Returned"),
    "returned_at": ("Returned",),
}


def status_agreement(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines whose status differs from their order's.

    Lines are counted per order and status first, so the join sees a handful of rows per order
    even if one order holds most lines.
    """
    per_order = items.groupBy("order_id", F.col("status").alias("item_status")).agg(
        F.count("*").alias("n_lines")
    )
    return per_order.join(
        orders.select("order_id", F.col("status").alias("order_status")), "order_id"
    ).agg(
        F.sum("n_lines").alias("compared_lines"),
        F.coalesce(
            F.sum(F.when(F.col("item_status") != F.col("order_status"), F.col("n_lines"))),
            F.lit(0),
        ).alias("mismatches"),
    )


def row_parity(raw: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of every raw table and its staging view, side by side."""
    counts = []
    for side, frames in (("raw_rows", raw), ("staged_rows", staged)):
        for name, frame in frames.items():
            counts.append(frame.agg(F.count("*").alias("n")).select(
                F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n"
            ))
    return (
        union_reports(counts).groupBy("table_name")
        .agg(
            F.max(F.when(F.col("side") == "raw_rows", F.col("n"))).alias("raw_rows"),
            F.max(F.when(F.col("side") == "staged_rows", F.col("n"))).alias("staged_rows"),
        )
        .withColumn("matches", F.col("raw_rows") == F.col("staged_rows"))
    )


def conditional_nulls(orders: DataFrame) -> DataFrame:
    """Lifecycle timestamps missing where the status requires them, or set where it forbids them."""
    known = F.col("status").isNotNull()
    counts = [F.count_if(known).alias("evaluated")]
    for column, statuses in LIFECYCLE.items():
        required = F.col("status").isin(*statuses)
        counts += [
            F.count_if(required & F.col(column).isNull()).alias(f"{column}_missing"),
            F.count_if(~required & F.col(column).isNotNull()).alias(f"{column}_unexpected"),
        ]
    rows = [
        F.struct(
            F.lit(column).alias("column_name"),
            F.col("evaluated").alias("evaluated"),
            F.col(f"{column}_missing").alias("missing"),
            F.col(f"{column}_unexpected").alias("unexpected"),
        )
        for column in LIFECYCLE
    ]
    return orders.agg(*counts).select(F.inline(F.array(*rows)))


def mart_raw_reconciliation(items: DataFrame, daily: DataFrame) -> DataFrame:
    """Total raw line price against the GMV of the daily mart."""
    raw_total = items.agg(F.sum("sale_price").alias("raw_total"))
    mart_total = daily.agg(F.sum("gmv").alias("mart_total"))
    return (
        raw_total.unionByName(mart_total, allowMissingColumns=True)
        .agg(F.max("raw_total").alias("raw_total"), F.max("mart_total").alias("mart_total"))
        .withColumn("diff", F.col("raw_total") - F.col("mart_total"))
    )


def price_covers_cost(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of known products that were sold under cost, or whose product has a negative cost."""
    costs = products.select("product_id", "cost")
    priced = items.select("product_id", "sale_price").join(costs, "product_id")
    return priced.agg(
        F.count("*").alias("evaluated"),
        F.count_if(F.col("sale_price") < F.col("cost")).alias("below_cost"),
        F.count_if(F.col("cost") < 0).alias("negative_cost"),
    )


def item_counts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose declared number of items differs from their number of lines."""
    counted = items.groupBy("order_id").agg(F.count("*").alias("n_lines"))
    compared = orders.select("order_id", "num_of_item").join(counted, "order_id", "left")
    return compared.agg(
        F.count("*").alias("evaluated"),
        F.count_if(F.col("num_of_item") != F.coalesce(F.col("n_lines"), F.lit(0)))
        .alias("violations"),
        F.sum("num_of_item").alias("declared_items"),
    )
