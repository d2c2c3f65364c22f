import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymart.functions.money import dollars, ratio, with_revenue_ladder
from tallymart.functions.timestamps import month_of, period_of, to_utc, utc_instant

TEXTS = [
    ("2024-03-10 06:59:00+00:00", dt.datetime(2024, 3, 10, 6, 59)),
    ("2024-11-03 01:30:00-04:00", dt.datetime(2024, 11, 3, 5, 30)),
    ("2024-11-03 01:30:00-05:00", dt.datetime(2024, 11, 3, 6, 30)),
    ("1969-12-31 23:59:59.123456+00:00", dt.datetime(1969, 12, 31, 23, 59, 59, 123456)),
    (None, None),
]


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_to_utc_does_not_depend_on_the_session_zone(spark, zone, name):
    zone(name)
    df = spark.createDataFrame(TEXTS, "text string, expected timestamp_ntz")
    rows = df.select("expected", to_utc(F.col("text")).alias("got")).collect()
    assert [r.got for r in rows] == [r.expected for r in rows]


@pytest.mark.parametrize("name", ["UTC", "America/New_York"])
def test_utc_instant_is_the_inverse(spark, zone, name):
    zone(name)
    df = spark.createDataFrame([(e,) for _, e in TEXTS], "naive timestamp_ntz")
    back = df.select("naive", to_utc(utc_instant(F.col("naive"))).alias("back")).collect()
    assert [r.back for r in back] == [r.naive for r in back]


def test_ladder_edges(spark):
    df = spark.createDataFrame(
        [("Shipped",), ("Complete",), ("Processing",), ("Cancelled",), ("Returned",), (None,),
         ("Lost",)], "status string").withColumn("sale_price", F.lit(10.0))
    rows = {r.status: r for r in with_revenue_ladder(df).collect()}

    def amounts(status):
        r = rows[status]
        return (r.gross_amount, r.net_amount, r.refund_amount, r.recognized_amount)

    assert amounts("Shipped") == amounts("Complete") == (10, 10, 0, 10)
    assert amounts("Processing") == amounts("Lost") == (10, 10, 0, 0)
    assert amounts("Cancelled") == (0, 0, 0, 0)
    assert amounts("Returned") == (10, 0, 10, 0)
    assert amounts(None) == (0, 0, 0, 0)
    unknown = rows[None]
    assert [unknown.is_gross, unknown.is_net, unknown.is_refund, unknown.is_recognized] == [None] * 4


def test_ratio_and_rounding(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (1.0, None), (1.0, -1.0)],
                               "a double, b double")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [
        None, 0.25, None, None]
    noisy = spark.createDataFrame([(2.4999999999,), (2.5,), (-1e-9,), (None,)], "x double")
    assert [r[0] for r in noisy.select(dollars(F.col("x"))).collect()] == [3.0, 3.0, 0.0, None]


def test_periods(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    got = df.select(month_of(F.col("d")), period_of(F.col("d"), "day"),
                    period_of(F.col("d"), "all")).first()
    assert tuple(got) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29), None)
    with pytest.raises(ValueError):
        period_of(F.col("d"), "week")
