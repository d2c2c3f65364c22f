import datetime as dt

from pyspark.sql import functions as F

from tallymart.operators import enrichment, staging
from tallymart.specs import RAW_TABLES
from tests.frames import by, day, staged_items, staged_orders, staged_products


def one(spark, table, **values):
    """A raw frame with one row; unnamed columns are NULL."""
    empty = spark.createDataFrame([], RAW_TABLES[table].schema)
    return spark.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in empty.schema])


def test_padded_status_is_trimmed_but_raises_no_flag(spark):
    row = staging.STAGING["orders"](one(spark, "orders", order_id=1, status=" Returned")).first()
    assert row.status == "Returned"
    assert row.is_returned is False and row.is_cancelled is False
    unknown = staging.STAGING["orders"](one(spark, "orders", order_id=1)).first()
    assert unknown.is_returned is None and unknown.shipped_at is None


def test_users_are_normalised(spark):
    row = staging.STAGING["users"](one(
        spark, "users", id=1, email="  Ann@Example.COM ", postal_code=" 01234", first_name="\tAnn ",
    )).first()
    assert (row.email, row.postal_code) == ("ann@example.com", "01234")
    assert row.first_name == "\tAnn"  # only spaces are trimmed


def test_event_users_round_half_to_even_and_may_be_missing(spark):
    for raw, expected in ((2.7, 3), (2.5, 2), (None, None)):
        assert staging.STAGING["events"](one(spark, "events", id=1, user_id=raw)).first().user_id == expected


def test_products_and_inventory(spark):
    product = staging.STAGING["products"](one(
        spark, "products", id=1, cost=4.0, retail_price=10.0, name=" hat ")).first()
    assert (product.unit_margin, product.product_name) == (6.0, "hat")
    unit = staging.STAGING["inventory_items"](one(
        spark, "inventory_items", id=1, product_retail_price=9.0,
        product_distribution_center_id=3)).first()
    assert (unit.retail_price, unit.distribution_center_id, unit.sold_at) == (9.0, 3, None)


def test_line_enrichment_keeps_orphans(spark):
    items = staged_items(spark, [(1, 10, 100, "Shipped", 30.0), (2, 99, 100, "Shipped", 5.0),
                                 (3, 10, 999, "Shipped", 7.0), (4, None, 100, None, 2.0),
                                 (5, 10, 999, "Cancelled", 7.0)])
    orders = staged_orders(spark, [(10, 1, "Shipped", day(2)), (11, 1, "Shipped", day(3))])
    products = staged_products(spark, [(100, "hats", 12.0)])
    rows = by(enrichment.line_enriched(items, orders, products), "order_item_id")
    assert len(rows) == 5
    assert rows[1].order_date == dt.date(2024, 1, 2) and rows[1].net_margin_amount == 18.0
    assert rows[2].order_date is None and rows[2].net_amount == 5.0
    assert rows[3].category is None and rows[3].net_margin_amount is None
    assert rows[4].net_amount == 0.0 and rows[4].is_net is None and rows[4].net_margin_amount == 0.0
    assert rows[5].net_margin_amount == 0.0


def test_order_rollup(spark):
    items = staged_items(spark, [(1, 10, 100, "Shipped", 30.0), (2, 10, 999, "Returned", 7.0),
                                 (3, 99, 100, "Shipped", 5.0), (4, 12, 999, "Shipped", 4.0)])
    orders = staged_orders(spark, [(10, 1, "Returned", day(2)), (11, 1, "Shipped", day(3)),
                                   (12, 1, "Cancelled", day(3)), (13, 1, None, day(3))])
    lines = enrichment.line_amounts(items, staged_products(spark, [(100, "hats", 12.0)]))
    rows = by(enrichment.order_enriched(orders, lines), "order_id")
    assert set(rows) == {10, 11, 12, 13}  # the line of order 99 vanishes
    assert (rows[10].item_count, rows[10].gmv_amount, rows[10].net_amount,
            rows[10].refund_amount, rows[10].net_margin_amount) == (2, 37.0, 30.0, 7.0, 18.0)
    assert rows[10].is_net_order is True  # returned orders count
    assert (rows[11].item_count, rows[11].gmv_amount) == (0, 0.0)
    assert rows[12].net_margin_amount == 0.0 and rows[12].is_net_order is False
    assert rows[13].is_net_order is None


def test_rollup_equals_the_full_enrichment(spark):
    items = staged_items(spark, [(i, i % 4, 100 + i % 3, s, float(i))
                                 for i, s in enumerate(["Shipped", "Returned", "Cancelled"] * 5)])
    orders = staged_orders(spark, [(i, 1, "Shipped", day(1 + i)) for i in range(5)])
    products = staged_products(spark, [(100, "hats", 1.0), (101, "caps", 2.0)])
    short = enrichment.order_enriched(orders, enrichment.line_amounts(items, products))
    full = enrichment.order_enriched(orders, enrichment.line_enriched(items, orders, products))
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, full.collect()))
