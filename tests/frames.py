"""Small raw and staged frames for unit tests."""

from __future__ import annotations

import datetime as dt

from tallymart.specs import RAW_TABLES

NOON = dt.datetime(2024, 1, 1, 12, 0, 0)


def day(n: int) -> dt.datetime:
    return NOON + dt.timedelta(days=n - 1)


def staged_orders(spark, rows):
    """rows: (order_id, user_id, status, created_at[, num_of_item])"""
    full = [(r[0], r[1], r[2], "F", r[4] if len(r) > 4 else 1, r[3], None, None, None,
             None if r[2] is None else r[2] == "Returned",
             None if r[2] is None else r[2] == "Cancelled") for r in rows]
    return spark.createDataFrame(
        full,
        "order_id bigint, user_id bigint, status string, gender string, num_of_item int, "
        "created_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz, "
        "returned_at timestamp_ntz, is_returned boolean, is_cancelled boolean",
    )


def staged_items(spark, rows):
    """rows: (order_item_id, order_id, product_id, status, sale_price)"""
    full = [(r[0], r[1], 1, r[2], r[0], r[3], r[4], NOON, None, None, None) for r in rows]
    return spark.createDataFrame(
        full,
        "order_item_id bigint, order_id bigint, user_id bigint, product_id bigint, "
        "inventory_item_id bigint, status string, sale_price double, created_at timestamp_ntz, "
        "shipped_at timestamp_ntz, delivered_at timestamp_ntz, returned_at timestamp_ntz",
    )


def staged_products(spark, rows):
    """rows: (product_id, category, cost)"""
    full = [(r[0], f"p{r[0]}", "b", r[1], "Men", f"s{r[0]}", r[2], 100.0,
             None if r[2] is None else 100.0 - r[2], 1) for r in rows]
    return spark.createDataFrame(
        full,
        "product_id bigint, product_name string, brand string, category string, "
        "department string, sku string, cost double, retail_price double, unit_margin double, "
        "distribution_center_id bigint",
    )


def staged_users(spark, ids):
    full = [(i, "A", "B", f"{i}@x", 30, "F", "c", "s", "01234", "US", 0.0, 0.0, "Search", NOON)
            for i in ids]
    return spark.createDataFrame(
        full,
        "user_id bigint, first_name string, last_name string, email string, age int, "
        "gender string, city string, state string, postal_code string, country string, "
        "latitude double, longitude double, traffic_source string, created_at timestamp_ntz",
    )


def empty_raw(spark):
    return {name: spark.createDataFrame([], spec.schema) for name, spec in RAW_TABLES.items()}


def by(df, key):
    """Collected rows by the value of one column."""
    return {row[key]: row for row in df.collect()}
