import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tallymart.plans import metrics
from tests.frames import by


def order_rows(spark, rows):
    """rows: (user_id, order_date, is_net_order, net_amount)"""
    return spark.createDataFrame(
        rows, "user_id bigint, order_date date, is_net_order boolean, net_amount double")


def test_aov_is_a_ratio_of_totals(spark):
    d = dt.date
    orders = order_rows(spark, [(1, d(2024, 1, 1), True, 10.0), (2, d(2024, 1, 2), True, 40.0),
                                (3, d(2024, 1, 2), True, 40.0), (3, d(2024, 2, 2), False, 0.0)])
    rows = by(metrics.monthly_aov(orders), "month")
    assert rows[d(2024, 1, 1)].aov == 30.0  # the mean of daily values would be 25
    assert rows[d(2024, 2, 1)].aov is None


def test_repeat_rate_is_judged_lifetime_to_date(spark):
    d = dt.date
    orders = order_rows(spark, [
        (1, d(2024, 1, 5), True, 1.0), (1, d(2024, 3, 5), True, 1.0), (2, d(2024, 3, 6), True, 1.0),
        (3, d(2024, 1, 7), True, 1.0), (3, d(2024, 1, 8), True, 1.0), (4, d(2024, 1, 9), False, 1.0),
        (None, d(2024, 1, 9), True, 1.0)])
    rows = by(metrics.monthly_repeat_rate(orders), "month")
    assert (rows[d(2024, 1, 1)].active_customers, rows[d(2024, 1, 1)].repeat_customers) == (2, 1)
    assert rows[d(2024, 3, 1)].repeat_rate == 0.5
    active = by(metrics.monthly_active_customers(orders), "month")
    assert active[d(2024, 1, 1)].active_customers == 2


def test_growth_is_null_after_a_gap(spark):
    d = dt.date
    lines = spark.createDataFrame(
        [("hats", d(2024, 1, 1), 10.0), ("hats", d(2024, 2, 1), 15.0), ("hats", d(2024, 4, 1), 9.0),
         ("caps", d(2024, 2, 1), 0.0), ("caps", d(2024, 3, 1), 5.0), (None, d(2024, 1, 1), 2.0),
         (None, d(2024, 2, 9), 3.0), ("hats", None, 99.0)],
        "category string, order_date date, net_amount double")
    rows = {(r.category, r.month.month): r for r in metrics.category_growth(lines).collect()}
    assert len(rows) == 7
    assert rows["hats", 2].growth == 0.5
    assert rows["hats", 1].growth is None and rows["hats", 4].growth is None
    assert rows["caps", 3].growth is None and rows["caps", 3].prior_net_revenue == 0.0
    assert rows[None, 2].growth == 0.5


def test_drop_alert_against_brute_force(spark):
    start = dt.date(2024, 1, 1)
    days = [(start + dt.timedelta(days=i), 100.0 + (i * 37 % 11))
            for i in range(90) if i % 7 != 3]
    days[50] = (days[50][0], 1.0)
    daily = spark.createDataFrame(days, "order_date date, net_revenue double")
    got = by(metrics.revenue_drop_alert(daily), "order_date")
    assert len(got) == len(days)
    for when, value in days:
        past = [v for d, v in days if 1 <= (when - d).days <= 28]
        row = got[when]
        assert row.history_days == len(past)
        if len(past) > 1:
            mean, sd = statistics.mean(past), statistics.stdev(past)
            assert row.mean_net_revenue == pytest.approx(mean)
            assert row.stddev_net_revenue == pytest.approx(sd)
            assert row.is_drop == (value < mean - 3 * sd)
        else:
            assert row.is_drop is False
    assert got[days[50][0]].is_drop is True


def test_count_based_refund_rate_and_ship_date(spark):
    t = dt.datetime(2024, 1, 31, 23, 0)
    items = spark.createDataFrame(
        [("Shipped", 1.0, t), ("Complete", 2.0, t), ("Returned", 4.0, t), ("Processing", 8.0, None),
         ("Shipped", 16.0, None)],
        "status string, sale_price double, shipped_at timestamp_ntz")
    row = metrics.refund_rate_by_count(items).first()
    assert (row.returned_items, row.shipped_items, row.refund_rate) == (1, 4, 0.25)
    shipped = metrics.recognition_by_ship_date(items).collect()
    assert [tuple(r) for r in shipped] == [(dt.date(2024, 1, 31), 2, 3.0)]


def test_event_metrics(spark):
    t = dt.datetime(2024, 1, 1, 5)
    events = spark.createDataFrame(
        [(t, "view", 1), (t, "view", None), (t, "purchase", 1), (t, "view", 2)],
        "created_at timestamp_ntz, event_type string, user_id bigint")
    rows = by(metrics.event_funnel_daily(events), "event_type")
    assert (rows["view"].events, rows["view"].users, rows["view"].anonymous_events) == (3, 2, 1)
    assert rows["purchase"].anonymous_share == 0.0
    assert metrics.daily_conversion(events).first().conversion_rate == 0.5


def test_kpis_for_any_grain_and_dimension(spark, sf_small):
    from tallymart.plans.layers import Layers
    from tallymart.sources.testdata import TestTables

    layers = Layers(TestTables(spark, sf_small))
    daily = metrics.order_kpis(layers.fct_orders, "day").withColumnRenamed("period", "order_date")
    assert sorted(map(tuple, daily.drop("gmv", "gross_revenue", "net_revenue", "net_margin",
                                        "recognized_revenue", "refunds", "aov", "refund_rate",
                                        "net_margin_rate").collect())) == sorted(
        map(tuple, layers.fct_daily_kpis.select("order_date", "total_orders", "net_orders",
                                                "active_customers").collect()))
    total = metrics.order_kpis(layers.fct_orders, "all").first()
    assert total.total_orders == 1500 and total.period is None
    ladder = metrics.line_revenue(layers.line_enriched, "all", ["category"])
    assert ladder.agg(F.sum("line_count")).first()[0] == 6000
