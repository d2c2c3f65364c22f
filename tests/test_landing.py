import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallymart.operators.staging import STAGING
from tallymart.sources.exchange import write_csv_drop
from tallymart.sources.landing import (
    MissingColumn,
    MissingSource,
    append_load_report,
    load_health,
    load_raw,
    read_csv,
    read_raw,
)
from tallymart.sources.testdata import TestTables
from tallymart.specs import RAW_TABLES

AT = dt.datetime(2024, 2, 1, 6, 0, 0, 999)


def header(table, spark):
    return ",".join(spark.createDataFrame([], RAW_TABLES[table].schema).columns)


@pytest.fixture
def drop(tmp_path, spark):
    folder = tmp_path / "drop"
    folder.mkdir()
    for table in RAW_TABLES:
        (folder / f"{table}.csv").write_text(header(table, spark) + "\n")
    users = folder / "users.csv"
    users.write_text(users.read_text() + (
        '7,Ann,"O""Neil, Jr",ANN@x.com,30,F,Texas,"1 Main, St",01234,Austin,United States,'
        "1.5,-2.5,Search,2024-03-10 06:59:00+00:00\n"
        "8,,,,,,,,,,,,,,2024-03-10 01:59:00-05:00\n"))
    return folder


@pytest.mark.parametrize("name", ["UTC", "America/New_York"])
def test_landing_keeps_text_and_instants(spark, zone, drop, tmp_path, name):
    zone(name)
    load_raw(spark, str(drop), str(tmp_path / "raw"), AT, strict=True)
    raw = read_raw(spark, str(tmp_path / "raw"))["users"]
    rows = {r.user_id: r for r in STAGING["users"](raw).collect()}
    assert rows[7].postal_code == "01234" and rows[7].last_name == 'O"Neil, Jr'
    assert rows[7].created_at == rows[8].created_at == dt.datetime(2024, 3, 10, 6, 59)
    assert rows[8].age is None and rows[8].email is None
    audit = raw.select("_loaded_at", "_source_file").distinct().collect()
    assert [tuple(r) for r in audit] == [(AT.replace(microsecond=0), "users.csv")]


def test_naive_timestamps_stay_utc(spark, zone, drop):
    zone("America/New_York")
    path = drop / "orders.csv"
    path.write_text(path.read_text() + (
        "1,7,Returned,F,2024-03-10 06:30:00,2024-03-10 02:30:00,2024-03-09 00:00:00,,1\n"))
    raw = read_csv(spark, str(path), RAW_TABLES["orders"].schema)
    row = STAGING["orders"](raw).first()
    assert row.created_at == dt.datetime(2024, 3, 10, 6, 30)  # no offset means UTC
    assert row.returned_at == dt.datetime(2024, 3, 10, 2, 30)
    assert row.delivered_at is None


def test_a_value_that_does_not_fit_fails_the_load(spark, drop, tmp_path):
    path = drop / "events.csv"
    path.write_text(path.read_text() + "x" + "," * 12 + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        load_raw(spark, str(drop), str(tmp_path / "raw"), AT)


def test_columns_are_matched_by_name(spark, tmp_path):
    path = tmp_path / "distribution_centers.csv"
    path.write_text("name,note,latitude,id,longitude\nMemphis,new,35.1,1,-89.9\n")
    row = read_csv(spark, str(path), RAW_TABLES["distribution_centers"].schema).first()
    assert (row.id, row.name, row.latitude, row.longitude, row.note) == (
        1, "Memphis", 35.1, -89.9, "new")
    path.write_text("name,latitude,id\nMemphis,35.1,1\n")
    with pytest.raises(MissingColumn, match="longitude"):
        read_csv(spark, str(path), RAW_TABLES["distribution_centers"].schema)


def test_part_files_must_share_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,latitude,longitude\n1,x,1.0,2.0\n")
    (tmp_path / "b.csv").write_text("id,latitude,name,longitude\n1,1.0,x,2.0\n")
    raw = read_csv(spark, str(tmp_path), RAW_TABLES["distribution_centers"].schema)
    with pytest.raises(Exception, match="header|CSV"):
        raw.collect()


def test_missing_files(spark, drop, tmp_path):
    raw_dir = str(tmp_path / "raw")
    with pytest.raises(MissingSource):
        load_raw(spark, str(tmp_path / "nowhere"), raw_dir, AT)
    (drop / "events.csv").unlink()
    with pytest.raises(MissingSource, match="events"):
        load_raw(spark, str(drop), raw_dir, AT, strict=True)
    assert not Path(raw_dir).exists()  # nothing was replaced
    report = {r.table_name: r for r in load_raw(spark, str(drop), raw_dir, AT).collect()}
    assert (report["events"].status, report["events"].rows) == ("skipped", None)
    assert (report["users"].status, report["users"].rows) == ("loaded", 2)
    assert set(read_raw(spark, raw_dir)) == set(RAW_TABLES) - {"events"}


def test_landing_again_replaces(spark, drop, tmp_path):
    raw_dir = str(tmp_path / "raw")
    for _ in range(2):
        load_raw(spark, str(drop), raw_dir, AT)
    assert read_raw(spark, raw_dir)["users"].count() == 2


def test_a_failed_load_leaves_the_tables_readable(spark, drop, tmp_path):
    raw_dir = str(tmp_path / "raw")
    load_raw(spark, str(drop), raw_dir, AT, strict=True)
    events, users = drop / "events.csv", drop / "users.csv"
    events.write_text(events.read_text() + "x" + "," * 12 + "\n")
    users.write_text(users.read_text() + "9" + "," * 14 + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        load_raw(spark, str(drop), raw_dir, AT)
    raw = read_raw(spark, raw_dir)
    assert set(raw) == set(RAW_TABLES)
    assert raw["users"].count() == 2 and raw["events"].count() == 0  # all or none


def test_a_skipped_table_stays(spark, drop, tmp_path):
    raw_dir = str(tmp_path / "raw")
    load_raw(spark, str(drop), raw_dir, AT)
    (drop / "users.csv").unlink()
    load_raw(spark, str(drop), raw_dir, AT)
    assert read_raw(spark, raw_dir)["users"].count() == 2


def test_folder_drops_name_the_file_and_the_part(spark, sf_small, tmp_path):
    write_csv_drop({"events": TestTables(spark, sf_small)["events"]}, str(tmp_path / "drop"))
    load_raw(spark, str(tmp_path / "drop"), str(tmp_path / "raw"), AT)
    rows = read_raw(spark, str(tmp_path / "raw"))["events"].select(
        "_source_file", "_source_part").distinct().collect()
    assert {r[0] for r in rows} == {"events.csv"} and all(r[1].startswith("part-") for r in rows)


def test_quoted_line_breaks(spark, drop, monkeypatch, tmp_path):
    from dataclasses import replace
    path = drop / "distribution_centers.csv"
    path.write_text(path.read_text() + '1,"two\nlines, ""quoted""",1.0,2.0\n2,plain,3.0,4.0\n')
    schema = RAW_TABLES["distribution_centers"].schema
    rows = read_csv(spark, str(path), schema, multiline=True).orderBy("id").collect()
    assert [r.name for r in rows] == ['two\nlines, "quoted"', "plain"]
    monkeypatch.setitem(RAW_TABLES, "distribution_centers", replace(
        RAW_TABLES["distribution_centers"], multiline=True))
    load_raw(spark, str(drop), str(tmp_path / "raw"), AT)
    landed = read_raw(spark, str(tmp_path / "raw"))["distribution_centers"]
    assert sorted(r.name for r in landed.collect()) == ["plain", 'two\nlines, "quoted"']


def test_written_line_breaks_come_back(spark, tmp_path, monkeypatch):
    from dataclasses import replace
    frame = spark.createDataFrame(
        [(1, 'a\nb\nc "d", e', 1.0, 2.0), (2, "plain", None, 0.5)],
        RAW_TABLES["distribution_centers"].schema)
    monkeypatch.setitem(RAW_TABLES, "distribution_centers", replace(
        RAW_TABLES["distribution_centers"], multiline=True))
    write_csv_drop({"distribution_centers": frame}, str(tmp_path / "drop"))
    load_raw(spark, str(tmp_path / "drop"), str(tmp_path / "raw"), AT)
    landed = read_raw(spark, str(tmp_path / "raw"))["distribution_centers"]
    assert sorted(r.name for r in landed.collect()) == ['a\nb\nc "d", e', "plain"]


def test_a_repeated_run_counts_once(spark, drop, tmp_path):
    log, raw = str(tmp_path / "log"), str(tmp_path / "raw")
    (drop / "events.csv").unlink()
    for _ in range(2):
        append_load_report(load_raw(spark, str(drop), raw, AT), "r0", log)
    row = load_health(spark.read.parquet(log)).first()
    assert (row.rows, row.tables_loaded, row.tables_skipped) == (2, 6, 1)


def test_line_keys_never_meet(spark, tmp_path):
    """Keys far beyond what any packed number could hold."""
    big = 10 ** 10
    lines = [(5, 1, 1_000_001, 1), (5, 2, 1, 1), (big, 1, 10 ** 9, 10 ** 8), (1, 11, 1, 1),
             (11, 1, 1, 1)]
    spark.createDataFrame(
        [(o, p, s, n, 1.0) for o, n, p, s in lines],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(o, 1, "O", dt.datetime(1995, 1, 1), "5-LOW") for o in {o for o, *_ in lines}],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, "
        "o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            ids = {r.id for r in TestTables(spark, str(tmp_path))["order_items"].collect()}
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert len(ids) == len(lines)


def test_health_compares_runs(spark, drop, tmp_path):
    log = str(tmp_path / "log")
    for i, at in enumerate((AT, AT + dt.timedelta(days=1))):
        append_load_report(load_raw(spark, str(drop), str(tmp_path / "raw"), at), f"r{i}", log)
        users = drop / "users.csv"
        users.write_text(users.read_text() + "9" + "," * 14 + "\n")
    rows = load_health(spark.read.parquet(log)).orderBy("run_id").collect()
    assert [(r.rows, r.rows_change, r.tables_loaded) for r in rows] == [(2, None, 7), (3, 1, 7)]


def test_csv_round_trip_is_lossless(spark, sf_small, tmp_path):
    tables = TestTables(spark, sf_small)
    write_csv_drop(tables, str(tmp_path / "drop"))
    load_raw(spark, str(tmp_path / "drop"), str(tmp_path / "raw"), AT, strict=True)
    for name, landed in read_raw(spark, str(tmp_path / "raw")).items():
        landed = landed.drop("_loaded_at", "_source_file", "_source_part")
        original = tables[name]
        assert landed.columns == original.columns
        fingerprint = F.sum(F.xxhash64(*[F.col(c).cast("string") for c in landed.columns])
                            .cast("decimal(38,0)"))
        assert (landed.agg(fingerprint, F.count("*")).first()
                == original.agg(fingerprint, F.count("*")).first()), name
