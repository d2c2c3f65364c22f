"""Typed, trimmed, UTC views over the raw tables.

Every function lists the columns of one view; :data:`STAGING` selects them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.timestamps import to_utc
from tallymart.specs import PII_TAG


def _id(name: str) -> Column:
    return F.col(name).cast("bigint")


def _key(name: str) -> Column:
    return F.col(name).cast("string")


def _int(name: str) -> Column:
    return F.col(name).cast("int")


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def _text(name: str) -> Column:
    return F.trim(F.col(name))


def _personal(column: Column, name: str) -> Column:
    """A column that identifies a person or a device, tagged as such."""
    return column.alias(name, metadata={PII_TAG: True})


def _naive(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def distribution_centers() -> list[Column]:
    return [
        _id("id").alias("distribution_center_id"),
        _text("name").alias("distribution_center_name"),
        _number("latitude").alias("latitude"),
        _number("longitude").alias("longitude"),
    ]


def products() -> list[Column]:
    """Catalogue with the unit margin worked out once."""
    texts = {"product_name": "name", "brand": "brand", "category": "category",
             "department": "department", "sku": "sku"}
    return [
        _id("id").alias("product_id"),
        *[_text(source).alias(target) for target, source in texts.items()],
        _number("cost").alias("cost"),
        _number("retail_price").alias("retail_price"),
        (_number("retail_price") - _number("cost")).alias("unit_margin"),
        _id("distribution_center_id").alias("distribution_center_id"),
    ]


def users() -> list[Column]:
    return [
        _id("id").alias("user_id"),
        _personal(_text("first_name"), "first_name"),
        _personal(_text("last_name"), "last_name"),
        _personal(F.lower(_text("email")), "email"),
        _int("age").alias("age"),
        *[_text(c).alias(c) for c in ("gender", "city", "state", "postal_code", "country")],
        _number("latitude").alias("latitude"),
        _number("longitude").alias("longitude"),
        _text("traffic_source").alias("traffic_source"),
        to_utc(F.col("created_at")).alias("created_at"),
    ]


def orders() -> list[Column]:
    """Order headers.

    ``created_at`` carries an offset and is normalised; the lifecycle timestamps are naive UTC
    already and NULL until the order reaches that stage. The two flags look at the status exactly
    as delivered: a padded status is trimmed in ``status`` but raises no flag.
    """
    delivered_status = F.col("status")
    return [
        _id("order_id").alias("order_id"),
        _id("user_id").alias("user_id"),
        _text("status").alias("status"),
        _text("gender").alias("gender"),
        _int("num_of_item").alias("num_of_item"),
        to_utc(F.col("created_at")).alias("created_at"),
        *[_naive(c).alias(c) for c in ("shipped_at", "delivered_at", "returned_at")],
        (delivered_status == "Returned").alias("is_returned"),
        (delivered_status == "Cancelled").alias("is_cancelled"),
    ]


def order_items() -> list[Column]:
    """Order lines; ``sale_price`` is the price actually paid."""
    stamps = ("created_at", "shipped_at", "delivered_at", "returned_at")
    return [
        _key("id").alias("order_item_id"),
        *[_id(c).alias(c) for c in ("order_id", "user_id", "product_id")],
        _key("inventory_item_id").alias("inventory_item_id"),
        _text("status").alias("status"),
        _number("sale_price").alias("sale_price"),
        *[to_utc(F.col(c)).alias(c) for c in stamps],
    ]


def inventory_items() -> list[Column]:
    """Stock units; ``sold_at`` is NULL while the unit is in stock."""
    texts = ("product_category", "product_name", "product_brand", "product_department",
             "product_sku")
    return [
        _key("id").alias("inventory_item_id"),
        _id("product_id").alias("product_id"),
        _id("product_distribution_center_id").alias("distribution_center_id"),
        *[_text(c).alias(c) for c in texts],
        _number("cost").alias("cost"),
        _number("product_retail_price").alias("retail_price"),
        to_utc(F.col("created_at")).alias("created_at"),
        to_utc(F.col("sold_at")).alias("sold_at"),
    ]


def events() -> list[Column]:
    """Clickstream. ``user_id`` arrives as a nullable double; halves round to even."""
    texts = ("event_type", "traffic_source", "browser", "uri", "city", "state", "postal_code")
    return [
        _id("id").alias("event_id"),
        F.bround(F.col("user_id")).cast("bigint").alias("user_id"),
        _text("session_id").alias("session_id"),
        _int("sequence_number").alias("sequence_number"),
        *[_text(c).alias(c) for c in texts],
        _personal(F.col("ip_address"), "ip_address"),
        to_utc(F.col("created_at")).alias("created_at"),
    ]


COLUMNS: dict[str, Callable[[], list[Column]]] = {
    f.__name__: f
    for f in (distribution_centers, products, users, orders, order_items, inventory_items, events)
}


def _view(table: str) -> Callable[[DataFrame], DataFrame]:
    def stage(raw: DataFrame) -> DataFrame:
        return raw.select(*COLUMNS[table]())

    return stage


# Table -> its staging view, which keeps one row per input row.
STAGING = {table: _view(table) for table in COLUMNS}


def raw_alias(column: str) -> str:
    return f"raw_{column}"


def beside_raw(table: str, raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The staging view with some raw columns beside it, so that one pass can judge both."""
    return raw.select(*COLUMNS[table](), *[F.col(c).alias(raw_alias(c)) for c in columns])
