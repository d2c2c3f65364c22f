"""Line enrichment and the order rollup.

Both lookups keep every line and expect one row per key on the right (the key contract in
``quality.contract`` checks it). No broadcast is forced: Catalyst broadcasts the catalogue only
while its size is under ``spark.sql.autoBroadcastJoinThreshold``, AQE revisits that with measured
sizes, and above it the sort-merge join with AQE skew splitting takes over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.money import AMOUNTS, net_margin, with_revenue_ladder

ORDER_SUMS = (*AMOUNTS, "net_margin_amount")


def line_amounts(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with ladder amounts and margin, and nothing else from orders or products.

    Costs are combined per product first. That makes the product key visibly unique, so Catalyst
    drops the whole lookup from any plan that does not use the margin.
    """
    costs = products.groupBy("product_id").agg(F.max("cost").alias("product_cost"))
    return _with_margin(with_revenue_ladder(items).join(costs, "product_id", "left"))


def _with_margin(lines: DataFrame) -> DataFrame:
    return lines.withColumn(
        "net_margin_amount",
        net_margin(F.col("is_net"), F.col("sale_price"), F.col("product_cost")),
    )


def line_enriched(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line with product and order context.

    The demand date is the day the order was created, not the day of the line. Lines without an
    order or product stay, with NULL context.
    """
    placed = orders.select("order_id", F.col("created_at").alias("order_created_at"))
    catalogue = products.select(
        "product_id", "product_name", "brand", "category", "department",
        F.col("cost").alias("product_cost"),
    )
    lines = items.select(
        "order_item_id", "order_id", "user_id", "product_id", "status", "sale_price"
    )
    context = lines.join(placed, "order_id", "left").join(catalogue, "product_id", "left")
    return _with_margin(with_revenue_ladder(context)).select(
        "order_item_id", "order_id", "user_id", "product_id", "status", "sale_price",
        "product_name", "brand", "category", "department", "product_cost",
        "order_created_at", F.col("order_created_at").cast("date").alias("order_date"),
        "is_gross", "is_net", "is_refund", "is_recognized",
        *ORDER_SUMS,
    )


def order_rollup(lines: DataFrame) -> DataFrame:
    """Line count and money per order. Map-side combining absorbs orders with many lines."""
    return lines.groupBy("order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("sale_price").alias("gmv_amount"),
        *[F.sum(c).alias(c) for c in ORDER_SUMS],
    )


def order_enriched(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """One row per order header with the money of its lines (0 for an order without lines).

    ``lines`` may come from :func:`line_amounts`: the rollup needs no order columns, so the line
    table is not joined to the headers first. A returned order still counts as a net order.
    """
    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return orders.join(order_rollup(lines), "order_id", "left").select(
        "order_id", "user_id", "status", "gender", "num_of_item", "created_at",
        F.col("created_at").cast("date").alias("order_date"),
        "shipped_at", "delivered_at", "returned_at", "is_returned", "is_cancelled",
        (F.col("status") != "Cancelled").alias("is_net_order"),
        or_zero("item_count"), or_zero("gmv_amount"), *[or_zero(c) for c in ORDER_SUMS],
    )
