"""Incremental landing and windowed counts over a stream."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallymart.sources.exchange import write_csv_drop
from tallymart.sources.testdata import TestTables
from tallymart.streaming import landing
from tallymart.streaming.events import closed_days, count_new_events
from tallymart.streaming.landing import land_new_files, landed_batches, read_landed

AT = dt.datetime(2024, 2, 1, 6, 0, 0, 500)


@pytest.fixture
def drop(spark, sf_small, tmp_path):
    """A folder of drops and a function that adds one."""
    orders, folder = TestTables(spark, sf_small)["orders"], str(tmp_path / "drop")

    def add(name, part):
        write_csv_drop({"orders": orders.where(part)}, f"{folder}/{name}")
        return orders.where(part).count()

    return folder, add


def ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


def test_only_new_files_are_landed(spark, drop, tmp_path):
    folder, add = drop
    raw = str(tmp_path / "raw")
    first = add("a", "order_id % 3 = 0")
    assert land_new_files(spark, folder, raw, "orders", AT) == first
    assert land_new_files(spark, folder, raw, "orders", AT) == 0
    second = add("b", "order_id % 3 = 1")
    assert land_new_files(spark, folder, raw, "orders", AT + dt.timedelta(days=1)) == second
    landed = read_landed(spark, raw, "orders")
    assert len(ids(landed)) == len(set(ids(landed))) == first + second
    assert read_landed(spark, raw, "orders", since=1).count() == second
    rows = landed_batches(spark, raw, "orders").orderBy("batch").collect()
    assert [(r.batch, r.rows) for r in rows] == [(0, first), (1, second)]
    stamps = landed.groupBy("_loaded_at").count().orderBy("_loaded_at").collect()
    assert [r["count"] for r in stamps] == [first, second]
    assert stamps[0]["_loaded_at"] == AT.replace(microsecond=0)
    assert landed.where(~F.col("_source_file").endswith(".csv")).count() == 0


def test_files_can_be_dealt_over_several_batches(spark, drop, tmp_path):
    folder, add = drop
    rows = add("a", "order_id % 2 = 0") + add("b", "order_id % 2 = 1")
    assert land_new_files(spark, folder, str(tmp_path / "raw"), "orders", AT, 1) == rows
    assert landed_batches(spark, str(tmp_path / "raw"), "orders").count() >= 2


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_batch_that_was_killed_around_its_commit_lands_once(
        spark, drop, tmp_path, monkeypatch, moment):
    folder, add = drop
    raw, rows = str(tmp_path / "raw"), add("a", "order_id % 2 = 0")
    plain = landing.put_if_absent

    def killed(*arguments):
        if moment == "after":
            assert plain(*arguments)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "put_if_absent", killed)
        with pytest.raises(StreamingQueryException):
            land_new_files(spark, folder, raw, "orders", AT)
    assert read_landed(spark, raw, "orders").count() == (rows if moment == "after" else 0)
    land_new_files(spark, folder, raw, "orders", AT)
    landed = ids(read_landed(spark, raw, "orders"))
    assert len(landed) == len(set(landed)) == rows
    assert landed_batches(spark, raw, "orders").count() == 1


def test_a_value_that_does_not_fit_fails_until_it_is_mended(spark, drop, tmp_path):
    folder, add = drop
    rows = add("a", "order_id < 40")
    bad = tmp_path / "drop" / "bad.csv"
    header = ",".join(read_header(tmp_path))
    bad.write_text(header + "\nnot-a-number" + "," * header.count(",") + "\n")
    raw = str(tmp_path / "raw")
    with pytest.raises(StreamingQueryException):
        land_new_files(spark, folder, raw, "orders", AT)
    assert read_landed(spark, raw, "orders").count() == 0
    bad.write_text(header + "\n")
    assert land_new_files(spark, folder, raw, "orders", AT) == rows


def read_header(tmp_path):
    part = next((tmp_path / "drop" / "a" / "orders.csv").glob("part-*.csv"))
    return part.read_text().splitlines()[0].split(",")


def events(spark, rows):
    return spark.createDataFrame(
        [(kind, dt.datetime(2024, 1, day, hour)) for day, hour, kind in rows],
        "event_type string, created_at timestamp_ntz")


def counted(spark, target):
    return sorted(((r.day.day, r.event_type, r.events) for r in
                   closed_days(spark, target).collect()), key=str)


def test_late_events_are_left_out_by_the_watermark_alone(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run(rows):
        events(spark, rows).coalesce(1).write.mode("append").parquet(source)
        return count_new_events(spark, source, target)

    run([(1, 1, "view"), (1, 5, "view"), (2, 3, "buy"), (3, 12, "view")])
    # The watermark stands at the 2nd, 12:00: the 1st is closed, the 2nd is not.
    assert counted(spark, target) == [(1, "view", 2)]
    run([(1, 9, "view"), (2, 9, "buy"), (2, 10, None), (3, 1, "view")])
    assert counted(spark, target) == [(1, "view", 2)]  # one event of the 1st came late
    query = run([(6, 0, "view"), (2, 11, "buy")])
    assert counted(spark, target) == sorted([
        (1, "view", 2), (2, "buy", 3), (2, None, 1), (3, "view", 2)], key=str)
    # Only the open day is still held.
    states = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
    assert states[-1].numRowsTotal == 1


def test_days_need_utc(spark, tmp_path, zone):
    zone("America/New_York")
    with pytest.raises(ValueError, match="UTC"):
        count_new_events(spark, str(tmp_path / "in"), str(tmp_path / "out"))
