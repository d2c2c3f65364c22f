import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.operators.enrichment import line_amounts, line_enriched, order_enriched
from tallymart.plans import business, marts
from tallymart.plans.layers import Layers
from tallymart.sources.testdata import TestTables
from tests.frames import (
    by,
    day,
    staged_items,
    staged_orders,
    staged_products,
    staged_users,
)


def orders_with_money(spark, rows, prices=10.0):
    """One line per order; rows: (order_id, user_id, status, created_at)."""
    items = staged_items(spark, [(r[0], r[0], 100, r[2], prices) for r in rows])
    lines = line_amounts(items, staged_products(spark, [(100, "hats", 4.0)]))
    return marts.fct_orders(order_enriched(staged_orders(spark, rows), lines))


def test_customers(spark):
    orders = orders_with_money(spark, [
        (1, 1, "Cancelled", day(1)), (2, 2, "Shipped", day(2)), (3, 3, "Returned", day(3)),
        (4, 4, "Shipped", day(4)), (5, 4, "Returned", day(5)), (6, 4, "Cancelled", day(9)),
        (7, 77, "Shipped", day(1)), (8, None, "Shipped", day(1))])
    users = staged_users(spark, [1, 2, 3, 4, 5])
    rows = by(marts.dim_customers(users, orders), "user_id")
    assert set(rows) == {1, 2, 3, 4, 5}
    assert {k: r.customer_segment for k, r in rows.items()} == {
        1: "never_purchased", 2: "one_time", 3: "one_time", 4: "repeat", 5: "never_purchased"}
    assert [rows[4].is_repeat_customer, rows[3].is_repeat_customer] == [True, False]
    assert rows[4].most_recent_order_date == dt.date(2024, 1, 5)  # the cancelled order is later
    assert rows[1].first_order_date is None and rows[5].lifetime_net_revenue == 0.0
    assert rows[3].lifetime_net_revenue == 0.0 and rows[4].lifetime_net_revenue == 10.0
    before = by(marts.dim_customers(users, orders, as_of=dt.date(2024, 1, 5)), "user_id")
    assert before[4].customer_segment == "one_time"


def test_daily_kpis_guard_their_ratios(spark):
    orders = orders_with_money(spark, [
        (1, 1, "Cancelled", day(1)), (2, 1, "Returned", day(2)), (3, 1, "Shipped", day(4)),
        (4, 1, "Processing", day(4)), (5, 2, "Cancelled", day(4))])
    rows = by(marts.fct_daily_kpis(orders), "order_date")
    assert set(rows) == {dt.date(2024, 1, d) for d in (1, 2, 4)}  # no row for the 3rd
    cancelled, returned, normal = (rows[dt.date(2024, 1, d)] for d in (1, 2, 4))
    assert (cancelled.aov, cancelled.refund_rate, cancelled.net_margin_rate) == (None, None, None)
    assert (returned.aov, returned.refund_rate, returned.net_margin_rate) == (0.0, 1.0, None)
    assert (normal.total_orders, normal.net_orders, normal.active_customers) == (3, 2, 1)
    assert (normal.gmv, normal.net_revenue, normal.recognized_revenue) == (30.0, 20.0, 10.0)
    assert (normal.aov, normal.net_margin_rate) == (10.0, 0.6)


def test_daily_mart_equals_a_plain_grouping(spark):
    orders = orders_with_money(spark, [
        (1, 1, "Cancelled", day(1)), (2, 1, "Returned", day(2)), (3, 1, "Shipped", day(4)),
        (4, 1, "Processing", day(4)), (5, None, "Shipped", day(4)), (6, 2, "Shipped", None),
        (7, 3, None, day(5))])
    one = marts.fct_daily_kpis(orders)
    two = (orders.groupBy("order_date").agg(*marts.kpi_aggregates())
           .withColumns(marts.kpi_ratios()).select(*marts.DAILY_COLUMNS))
    assert one.columns == two.columns
    def rows(df):
        return sorted(map(tuple, df.collect()), key=str)
    assert rows(one) == rows(two) and len(rows(one)) == 5


def test_recognition_reconciles(spark):
    orders = orders_with_money(spark, [(1, 1, "Shipped", day(1)), (2, 1, "Processing", day(1)),
                                       (3, 1, "Returned", day(1))])
    row = marts.fct_revenue_recognition(orders).first()
    assert (row.recognized_revenue, row.processing_deferred, row.net_revenue_mgmt,
            row.recon_check, row.refunds, row.gross_revenue) == (10, 10, 20, 20, 10, 30)


def test_products_match_the_line_by_line_margin(spark):
    items = staged_items(spark, [
        (1, 1, 100, "Shipped", 30.0), (2, 1, 100, "Returned", 7.0), (3, 1, 100, None, 9.0),
        (4, 1, 100, "Shipped", None), (5, 1, 101, "Cancelled", 5.0), (6, 1, 102, "Shipped", 5.0),
        (7, 1, 999, "Shipped", 5.0)])
    products = staged_products(spark, [(100, "a", 12.0), (101, "a", 1.0), (102, "b", None),
                                       (103, "b", 1.0)])
    rows = by(marts.dim_products(products, items), "product_id")
    by_line = by(
        line_enriched(items, staged_orders(spark, [(1, 1, "Shipped", day(1))]), products)
        .groupBy("product_id").agg(F.sum("net_margin_amount").alias("margin")), "product_id")
    assert set(rows) == {100, 101, 102, 103}
    for key, row in rows.items():
        expected = by_line[key].margin if key in by_line else None
        assert row.net_margin == pytest.approx(expected or 0.0)
    assert (rows[100].units_sold_net, rows[100].net_revenue, rows[100].refunds) == (2, 30.0, 7.0)
    assert (rows[103].units_sold_net, rows[103].net_revenue) == (0, 0.0)


def test_dashboard_falls_back_to_zero(spark):
    orders = orders_with_money(spark, [(1, 1, "Cancelled", day(1))])
    customers = marts.dim_customers(staged_users(spark, [1]), orders)
    row = business.dashboard_kpis(marts.fct_daily_kpis(orders), customers).first()
    assert (row.aov, row.repeat_rate, row.refund_rate, row.net_margin_rate) == (0, 0, 0, 0)
    assert (row.date_min, row.purchasers, row.gmv) == ("2024-01-01", 0, 10.0)
    headline = business.headline_kpis(marts.fct_daily_kpis(orders)).first()
    assert headline.aov is None and headline.refund_rate is None


def test_category_question_keeps_null_but_chart_does_not(spark):
    items = staged_items(spark, [(1, 1, 100, "Shipped", 30.0), (2, 1, 101, "Shipped", 9.0)])
    products = marts.dim_products(
        staged_products(spark, [(100, None, 1.0), (101, "caps", 1.0)]), items)
    assert [tuple(r) for r in business.revenue_by_category(products).collect()] == [
        (None, 30.0), ("caps", 9.0)]
    assert [r.category for r in business.top_categories(products).collect()] == ["caps"]


ANCHORS = {
    "0.001": (1094, 1500, 1412, 1412, 317364757.31, 299003700.10, 278290500.55, 195946136.46,
              20713199.55, 275419260.49),
    "0.01": (2399, 15000, 13979, 13948, 3183256271.63, 2963477366.02, 2751540713.91,
             1886543088.18, 211936652.11, 2721959887.83),
    "0.1": (2405, 150000, 139839, 139517, 31771202123.60, 29621533154.18, 27510894845.92,
            19015915967.40, 2110638308.26, 27214798627.36),
}


@pytest.mark.parametrize("scale", ANCHORS)
def test_published_totals(spark, sf_small, scale):
    layers = Layers(TestTables(spark, sf_small.replace("0.001", scale)))
    row = layers.fct_daily_kpis.agg(
        F.count("*"), F.sum("total_orders"), F.sum("net_orders"), F.sum("active_customers"),
        *[F.round(F.sum(c), 2) for c in ("gmv", "gross_revenue", "net_revenue",
                                         "recognized_revenue", "refunds", "net_margin")]).first()
    assert tuple(row) == ANCHORS[scale]


def test_segments_as_of(spark, sf_medium):
    layers = Layers(TestTables(spark, sf_medium))
    customers = marts.dim_customers(
        layers.staged("users"), layers.fct_orders, as_of=dt.date(1996, 1, 1))
    counts = {r.customer_segment: r.customers
              for r in business.customer_segments(customers).collect()}
    assert counts == {"never_purchased": 367, "one_time": 514, "repeat": 619}


def test_totals_agree_across_dimensions(spark, sf_small):
    layers = Layers(TestTables(spark, sf_small))
    def total(df, c):
        return df.agg(F.round(F.sum(c), 2)).first()[0]
    net = total(layers.fct_daily_kpis, "net_revenue")
    assert net == total(layers.dim_products, "net_revenue")
    assert net == total(layers.dim_customers, "lifetime_net_revenue")
    assert net == total(layers.fct_revenue_recognition, "recon_check")
    assert total(layers.fct_daily_kpis, "gmv") == total(layers.raw["order_items"], "sale_price")
    assert total(layers.fct_daily_kpis, "net_margin") == total(layers.dim_products, "net_margin")
