"""Declared tables: raw schemas, keys, references, accepted values and sensitive columns."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the business domain.
ORDER_STATUSES = ("Shipped", "Complete", "Processing", "Cancelled", "Returned")
CUSTOMER_SEGMENTS = ("never_purchased", "one_time", "repeat")

# Freshness thresholds on the landing timestamp, in hours.
WARN_AFTER_HOURS = 26
ERROR_AFTER_HOURS = 48


@dataclass(frozen=True)
class Reference:
    """A many-to-one reference from ``column`` to ``parent.parent_column``."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """Contract of one source table."""

    name: str
    description: str
    schema: str
    key: str
    references: tuple[Reference, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # The staged column that holds the key, value for value.
    staged_key: str = ""
    # Quoted fields may hold line breaks; such a file cannot be split between tasks.
    multiline: bool = False
    warn_after_hours: int = WARN_AFTER_HOURS
    error_after_hours: int = ERROR_AFTER_HOURS


# Ids are 64-bit; ids of lines and stock units are text, as systems make them from several keys.
# ``timestamp`` columns carry an offset in the source text, ``timestamp_ntz`` columns are naive UTC.
RAW_TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            "distribution_centers",
            "Fulfilment centres that products ship from.",
            "id bigint, name string, latitude double, longitude double",
            key="id",
            staged_key="distribution_center_id",
        ),
        TableSpec(
            "products",
            "Product catalogue.",
            (
                "id bigint, cost double, category string, name string, brand string, "
                "retail_price double, department string, sku string, "
                "distribution_center_id bigint"
            ),
            key="id",
            staged_key="product_id",
            references=(Reference("distribution_center_id", "distribution_centers", "id"),),
        ),
        TableSpec(
            "users",
            "Registered customers.",
            (
                "id bigint, first_name string, last_name string, email string, age int, "
                "gender string, state string, street_address string, postal_code string, "
                "city string, country string, latitude double, longitude double, "
                "traffic_source string, created_at timestamp"
            ),
            key="id",
            staged_key="user_id",
        ),
        TableSpec(
            "orders",
            "Order headers, one row per order.",
            (
                "order_id bigint, user_id bigint, status string, gender string, "
                "created_at timestamp, returned_at timestamp_ntz, shipped_at timestamp_ntz, "
                "delivered_at timestamp_ntz, num_of_item int"
            ),
            key="order_id",
            staged_key="order_id",
            references=(Reference("user_id", "users", "id"),),
            accepted={"status": ORDER_STATUSES},
        ),
        TableSpec(
            "order_items",
            "Order lines, one row per product unit sold.",
            (
                "id string, order_id bigint, user_id bigint, product_id bigint, "
                "inventory_item_id string, status string, created_at timestamp, "
                "shipped_at timestamp, delivered_at timestamp, returned_at timestamp, "
                "sale_price double"
            ),
            key="id",
            staged_key="order_item_id",
            references=(Reference("order_id", "orders", "order_id"),),
        ),
        TableSpec(
            "inventory_items",
            "Stock units; links products to sales.",
            (
                "id string, product_id bigint, created_at timestamp, sold_at timestamp, "
                "cost double, product_category string, product_name string, "
                "product_brand string, product_retail_price double, "
                "product_department string, product_sku string, "
                "product_distribution_center_id bigint"
            ),
            key="id",
            staged_key="inventory_item_id",
        ),
        TableSpec(
            "events",
            "Clickstream; user_id is empty for anonymous sessions.",
            (
                "id bigint, user_id double, sequence_number int, session_id string, "
                "created_at timestamp, ip_address string, city string, state string, "
                "postal_code string, browser string, traffic_source string, uri string, "
                "event_type string"
            ),
            key="id",
            staged_key="event_id",
        ),
    )
}

# Columns that identify a person or a device.
PII_COLUMNS = ("first_name", "last_name", "email", "ip_address")
# Key of the tag in the metadata of a field that holds personal data.
PII_TAG = "pii"
