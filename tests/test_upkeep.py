"""Marts kept up by period, additive bitmaps, bucketed layers and tagged columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallymart.governance.access import personal_columns, tag_pii, without_pii
from tallymart.plans import actives, marts, refresh
from tallymart.plans.bucketed import bucketed_layers
from tallymart.plans.layers import Layers
from tallymart.quality.mutation import smallest_keys
from tallymart.sources.testdata import TestTables


def facts(spark, rows):
    """rows: (order_id, user_id, day or None, net amount)"""
    columns = [c for c, _ in marts.LADDER_SUMS.items()]
    assert columns
    frame = spark.createDataFrame(
        [(i, u, None if d is None else dt.date(2024, 1, d), a) for i, u, d, a in rows],
        "order_id long, user_id long, order_date date, a double")
    return frame.select(
        "order_id", "user_id", "order_date", F.lit(True).alias("is_net_order"),
        *[F.col("a").alias(c) for c in marts.LADDER_SUMS.values()])


def kept_up(spark, root, table):
    found = refresh.read_by_period(spark, root, table).drop(refresh.PERIOD)
    return sorted((tuple(sorted(r.asDict().items())) for r in found.collect()), key=str)


def rebuilt(frame):
    return sorted((tuple(sorted(r.asDict().items())) for r in frame.collect()), key=str)


@pytest.mark.parametrize("unit", refresh.UNITS)
def test_a_refresh_equals_a_rebuild(spark, tmp_path, unit):
    root = str(tmp_path)
    first = [(1, 1, 1, 5.0), (2, 2, 1, 7.0), (3, 1, 2, 1.0), (4, 3, 9, 2.0), (5, 3, None, 4.0)]
    batch = [(2, 2, 1, 70.0), (6, 4, 1, 1.0), (7, 4, 20, 3.0), (8, 9, None, 1.0)]
    refresh.build(facts(spark, first), root, unit)
    before = set(refresh.read_by_period(spark, root, "fct_daily_kpis").inputFiles())
    for _ in range(2):  # again, as after an interruption
        periods = refresh.refresh(facts(spark, batch), root, unit)
        days = {dt.date(2024, 1, 1), dt.date(2024, 1, 20), None}
        assert set(periods) == (days if unit == "day" else {dt.date(2024, 1, 1), None})
        now = {r[0]: r for r in first} | {r[0]: r for r in batch}
        after = facts(spark, list(now.values()))
        assert kept_up(spark, root, "fct_orders") == rebuilt(after)
        assert kept_up(spark, root, "fct_daily_kpis") == rebuilt(marts.fct_daily_kpis(after))
        assert kept_up(spark, root, "fct_revenue_recognition") == rebuilt(
            marts.fct_revenue_recognition(after))
    untouched = before & set(refresh.read_by_period(spark, root, "fct_daily_kpis").inputFiles())
    assert len(untouched) == (2 if unit == "day" else 0)
    assert refresh.refresh(facts(spark, []), root, unit) == []


def test_a_refresh_reads_touched_partitions_alone(spark, tmp_path):
    refresh.build(facts(spark, [(i, i, 1 + i % 20, 1.0) for i in range(100)]), str(tmp_path))
    frame = refresh.read_by_period(spark, str(tmp_path), "fct_orders")
    some = refresh.of_periods(frame, [dt.date(2024, 1, 3), None])
    assert some.count() == 5
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in plan and "_period" in plan.split("PartitionFilters")[1]
    with pytest.raises(ValueError):
        refresh.build(frame, str(tmp_path), "week")


def test_bitmaps_add_up(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.randrange(10), rng.randrange(10**6), 2**40 + rng.randrange(5)]),
             rng.choice([None, *range(1, 29)]), 1.0) for i in range(2000)]
    orders = facts(spark, rows).withColumn("is_net_order", F.col("order_id") % 3 > 0)
    daily = actives.daily_actives(orders)
    seen = {(u, d) for i, u, d, _ in rows if u is not None and d is not None and i % 3 > 0}
    days = {r.period.day: r.active_customers
            for r in actives.active_customers(daily, "day").collect()}
    assert days == {d: len({u for u, x in seen if x == d}) for d in {d for _, d in seen}}
    for grain in ("month", "quarter", "year", "all"):
        [row] = actives.active_customers(daily, grain).collect()
        assert row.active_customers == len({u for u, _ in seen})
        assert row.period == (None if grain == "all" else dt.date(2024, 1, 1))
    between = actives.actives_between(daily, F.lit(dt.date(2024, 1, 5)), F.lit(dt.date(2024, 1, 9)))
    assert between.first().active_customers == len({u for u, d in seen if 5 <= d <= 9})
    months = actives.merged(daily, "month").withColumnRenamed("period", "order_date")
    assert actives.active_customers(months, "year").first().active_customers == len(
        {u for u, _ in seen})  # merged bitmaps merge again
    with pytest.raises(ValueError):
        actives.merged(daily, "week")


def test_periods_shuffle_no_customers(spark, tmp_path):
    actives.daily_actives(facts(spark, [(1, 1, 1, 1.0)])).write.parquet(str(tmp_path / "d"))
    plan = actives.active_customers(spark.read.parquet(str(tmp_path / "d")), "quarter")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in text and "partial_bitmap_or_agg" in text


BETWEEN = "100k"  # above the size of the catalogue, below that of customers and orders


def exchanges(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange hashpartitioning" in line]


def test_bucketed_tables_are_joined_where_they_lie(spark, sf_medium, tmp_path):
    plain = Layers(TestTables(spark, sf_medium))
    layers = bucketed_layers(plain, "bucketed_test", str(tmp_path), 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    joins = {"line_enriched": "order_item_id", "order_enriched": "order_id",
             "dim_customers": "user_id"}
    for name, key in joins.items():
        ours, theirs = (sorted(r[0] for r in getattr(x, name).select(key).collect())
                        for x in (layers, plain))
        assert ours == theirs
    # The catalogue is small enough to be broadcast; customers and orders are not by this bound.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", BETWEEN)
    try:
        for name in joins:
            moved = exchanges(getattr(layers, name))
            assert all("product_id" in line for line in moved), (name, moved)
            assert len(exchanges(getattr(plain, name))) > len(moved)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tags_follow_columns(spark, sf_small, tmp_path):
    users = Layers(TestTables(spark, sf_small)).dim_customers
    renamed = users.select("user_id", F.col("email").alias("contact"), "city",
                           F.col("first_name").alias("city_name"))
    assert personal_columns(renamed) == ["contact", "city_name"]
    joined = renamed.alias("a").join(users.select("user_id", "country").alias("b"), "user_id")
    assert without_pii(joined).columns == ["user_id", "city", "country"]
    renamed.write.parquet(str(tmp_path / "t"))
    assert without_pii(spark.read.parquet(str(tmp_path / "t"))).columns == ["user_id", "city"]
    assert without_pii(renamed.groupBy("contact").count()).columns == ["count"]
    derived = tag_pii(users.select(F.lower("email").alias("key"), "city"), ["key"])
    assert without_pii(derived).columns == ["city"]
    events = Layers(TestTables(spark, sf_small)).staged("events")
    assert "ip_address" not in without_pii(events).columns
    bare = spark.createDataFrame([(1, "x")], "id int, `Email` string")  # no tags: names decide
    assert without_pii(bare).columns == ["id"]


@pytest.mark.parametrize("keys, expected", [
    ([], (None, None)), ([None], (None, None)), ([3], (3, None)), ([3, 3, 5, 4, None], (3, 4))])
def test_smallest_keys(spark, keys, expected):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(3)
    assert smallest_keys(df, "k") == expected
    assert not exchanges(df.agg(F.min("k")))[1:]
