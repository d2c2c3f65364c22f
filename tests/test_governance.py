import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.governance import access
from tallymart.governance.publish import (
    GateClosed,
    attach_marts,
    live_marts,
    live_run,
    publish,
    read_run,
    refresh,
    resolver,
)
from tallymart.plans.layers import MARTS, Layers
from tallymart.plans.registry import TEST_BANDS
from tallymart.quality.suites import run_contracts
from tallymart.sources.exchange import write_csv_drop
from tallymart.sources.testdata import TestTables

NOW = dt.datetime(2024, 2, 1, 6)


def fingerprint(df):
    return df.agg(F.count("*"), F.sum(F.xxhash64(*[
        F.round(c, 2) if kind == "double" else F.col(c) for c, kind in df.dtypes
    ]).cast("decimal(38,0)"))).first()


@pytest.fixture(scope="module")
def feed(spark, sf_medium, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed"))
    write_csv_drop(TestTables(spark, sf_medium), folder)
    return folder


def test_refresh_publishes_and_repeats_itself(spark, feed, tmp_path):
    root = str(tmp_path)
    assert live_run(spark, root) is None
    report = refresh(spark, feed, root, NOW, bands=TEST_BANDS)
    assert report.count() == 84
    first = {m: fingerprint(df) for m, df in live_marts(spark, root).items()}
    refresh(spark, feed, root, NOW + dt.timedelta(days=1), bands=TEST_BANDS)
    assert live_run(spark, root) == "20240202T060000"
    assert {m: fingerprint(df) for m, df in live_marts(spark, root).items()} == first
    assert set(first) == set(MARTS)
    attach_marts(spark, root)
    row = spark.sql("""
        SELECT round(sum(net_revenue), 2) AS net, sum(net_orders) AS orders,
               (SELECT count(*) FROM main_marts.dim_customers WHERE is_repeat_customer) AS repeaters
        FROM main_marts.fct_daily_kpis""").first()
    assert (row.net, row.orders, row.repeaters) == (2751540713.91, 13979, 1497)
    log = spark.read.parquet(f"{root}/load_log")
    assert log.select("run_id").distinct().count() == 2


def test_a_closed_gate_keeps_the_last_good_version(spark, sf_medium, tmp_path):
    layers, root = Layers(TestTables(spark, sf_medium)), str(tmp_path)
    publish(layers, root, "good", NOW, TEST_BANDS)
    before = fingerprint(live_marts(spark, root)["fct_orders"])

    broken = dict(layers.raw.items())
    broken["order_items"] = broken["order_items"].withColumn(
        "sale_price", F.when(F.col("order_id") == 7, F.lit(-1.0)).otherwise(F.col("sale_price")))
    with pytest.raises(GateClosed) as closed:
        publish(Layers(broken), root, "bad", NOW + dt.timedelta(days=1), TEST_BANDS)
    assert "stg_order_items.sale_price between" in closed.value.failures
    assert "stg_order_items.sale_price rule:non_negative_price" in closed.value.failures
    assert live_run(spark, root) == "good"
    assert fingerprint(live_marts(spark, root)["fct_orders"]) == before
    assert fingerprint(read_run(spark, root, closed.value.folder)["fct_orders"]) != before

    # A retry under the id of the live run touches nothing that readers see either.
    live = {m: fingerprint(df) for m, df in live_marts(spark, root).items()}
    with pytest.raises(GateClosed):
        publish(Layers(broken), root, "good", NOW, TEST_BANDS)
    assert {m: fingerprint(df) for m, df in live_marts(spark, root).items()} == live
    publish(layers, root, "good", NOW, TEST_BANDS)
    assert {m: fingerprint(df) for m, df in live_marts(spark, root).items()} == live


def test_contract_violations_are_reported(spark, sf_medium):
    raw = dict(TestTables(spark, sf_medium).items())
    third = F.col("order_id") == 3
    raw["orders"] = raw["orders"].withColumns({
        "status": F.when(third, F.lit("Lost")).otherwise(F.col("status")),
        "user_id": F.when(third, F.lit(-1)).otherwise(F.col("user_id")),
    })
    raw["users"] = raw["users"].unionAll(raw["users"].filter("id = 4"))
    report = run_contracts(resolver(Layers(raw)), ("unique", "accepted_values", "relationships"))
    failed = {(r.table_name, r.column_name, r.check_name, r.violations)
              for r in report.filter("NOT success").collect()}
    # The duplicated customer also doubles the customer dimension.
    assert failed == {
        ("raw.orders", "status", "accepted_values", 1),
        ("stg_orders", "status", "accepted_values", 1),
        ("fct_orders", "status", "accepted_values", 1),
        ("raw.orders", "user_id", "relationships", 1),
        ("fct_orders", "user_id", "relationships", 1),
        ("raw.users", "id", "unique", 1),
        ("stg_users", "user_id", "unique", 1),
        ("dim_customers", "user_id", "unique", 1),
    }


def test_roles(spark, sf_small):
    mart = Layers(TestTables(spark, sf_small)).mart
    names = access.register_views("marketing", mart)
    assert len(names) == len(access.KPI_SET)
    assert spark.table("marketing_daily_kpis").count() == 1094
    for subject in access.FINANCE_SET:
        with pytest.raises(access.AccessDenied):
            access.read_subject("marketing", subject, mart)
        with pytest.raises(access.AccessDenied):
            access.read_subject("someone", subject, mart)
        access.read_subject("finance", subject, mart)
    customers = access.without_pii(mart("dim_customers"))
    assert not set(customers.columns) & {"first_name", "last_name", "email", "ip_address"}
    assert "city" in customers.columns
