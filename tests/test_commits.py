"""Versions by several writers, snapshots of raw tables and views that follow the live marts."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tallymart.governance import publish as publishing
from tallymart.governance.publish import attach_marts, live_marts, publications, publish
from tallymart.plans.layers import Layers
from tallymart.plans.registry import TEST_BANDS
from tallymart.sources import commits, landing
from tallymart.sources.commits import CommitLog, put_if_absent, rename_if_absent
from tallymart.sources.exchange import write_csv_drop
from tallymart.sources.landing import VersionGone, forget_before, load_raw, raw_versions, read_raw
from tallymart.sources.testdata import TestTables

AT = dt.datetime(2024, 2, 1, 6)


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert put_if_absent(spark, path, "first") and not put_if_absent(spark, path, "second")
    assert open(path).read() == "first"
    assert commits.names(spark, f"{tmp_path}/log") == ["1.json"]


def test_renaming_never_writes_over_a_file(spark, tmp_path):
    """The way taken on file systems other than a local disk."""
    for name in ("new", "other", "target"):
        (tmp_path / name).write_text(name)
    paths = {n: commits._path(spark, f"{tmp_path}/{n}")[0] for n in ("new", "other", "target", "x")}
    assert not rename_if_absent(spark, paths["new"], paths["target"])
    assert (tmp_path / "target").read_text() == "target" and not (tmp_path / "new").exists()
    assert rename_if_absent(spark, paths["other"], paths["x"])
    assert (tmp_path / "x").read_text() == "other"


def test_writers_at_once_lose_nothing(spark, tmp_path):
    log, start = CommitLog(spark, f"{tmp_path}/log"), Barrier(6)

    def write(name):
        start.wait()
        for n in range(5):
            log.commit(lambda newest: {"seen": [*(newest["seen"] if newest else []), [name, n]]})

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(write, range(6)))
    assert log.versions() == list(range(1, 31))
    seen = log.newest()["seen"]
    assert sorted(seen) == [[w, n] for w in range(6) for n in range(5)]
    assert all([s for s in seen if s[0] == w] == [[w, n] for n in range(5)] for w in range(6))


def test_a_writer_that_never_wins_gives_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "put_if_absent", lambda *_: False)
    with pytest.raises(commits.Contended):
        CommitLog(spark, f"{tmp_path}/log").commit(lambda _: {})


def test_two_publishers_give_two_versions(spark, sf_small, tmp_path, monkeypatch):
    """Both have read the log before either commits."""
    layers = Layers(TestTables(spark, sf_small))
    monkeypatch.setattr(publishing, "audit", lambda *_: spark.createDataFrame(
        [("s", "t", "c", "k", True, 1, 0)], publishing.REPORT_SCHEMA))
    both, plain = Barrier(2, timeout=300), CommitLog.newest

    def together(self):
        found = plain(self)
        if found is None and not both.broken:
            both.wait()
        return found

    monkeypatch.setattr(CommitLog, "newest", together)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda run: publish(layers, str(tmp_path), run, AT, TEST_BANDS), "ab"))
    monkeypatch.setattr(CommitLog, "newest", plain)
    log = publications(spark, str(tmp_path))
    entries = [log.read(v) for v in log.versions()]
    assert [e["version"] for e in entries] == [1, 2] and {e["run_id"] for e in entries} == {"a", "b"}
    assert len({e["folder"] for e in entries}) == 2
    assert live_marts(spark, str(tmp_path))["fct_daily_kpis"].count() == 1094


def test_views_follow_the_live_version(spark, sf_small, tmp_path, monkeypatch):
    tables = TestTables(spark, sf_small)
    monkeypatch.setattr(publishing, "audit", lambda *_: spark.createDataFrame(
        [("s", "t", "c", "k", True, 1, 0)], publishing.REPORT_SCHEMA))
    root, ask = str(tmp_path), """
        SELECT (SELECT count(*) FROM following.fct_orders) AS orders,
               (SELECT sum(total_orders) FROM following.fct_daily_kpis) AS daily"""
    publish(Layers(tables), root, "all", AT)
    attach_marts(spark, root, "following")
    assert tuple(spark.sql(ask).first()) == (1500, 1500)
    fewer = dict(tables.items())
    fewer["orders"] = fewer["orders"].where("order_id % 2 = 0")
    publish(Layers(fewer), root, "some", AT)
    rows = fewer["orders"].count()
    assert 0 < rows < 1500 and tuple(spark.sql(ask).first()) == (rows, rows)
    plan = spark.sql("SELECT * FROM following.fct_orders")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(attempt" in plan


@pytest.fixture
def three_loads(spark, sf_small, tmp_path):
    """Raw tables after three loads of orders; the second one brings customers too."""
    tables, raw_dir = TestTables(spark, sf_small), str(tmp_path / "raw")
    drops = [tables["orders"].where(f"order_id % 3 <> {n}") for n in range(3)]
    for n, orders in enumerate(drops):
        brings = {"orders": orders} | ({"users": tables["users"]} if n == 1 else {})
        write_csv_drop(brings, f"{tmp_path}/drop{n}")
        load_raw(spark, f"{tmp_path}/drop{n}", raw_dir, AT + dt.timedelta(days=n))
    return raw_dir, [d.count() for d in drops]


def test_reading_as_of_a_version(spark, three_loads):
    raw_dir, counts = three_loads
    for version, count in enumerate(counts, 1):
        found = read_raw(spark, raw_dir, version)
        assert found["orders"].count() == count
        assert found["orders"].where(f"order_id % 3 = {version - 1}").count() == 0
        assert ("users" in found) == (version > 1)
    assert read_raw(spark, raw_dir)["orders"].count() == counts[2]
    rows = raw_versions(spark, raw_dir).orderBy("version").collect()
    assert [(r.version, r.tables) for r in rows] == [
        (1, ["orders"]), (2, ["orders", "users"]), (3, ["orders"])]
    assert [r.loaded_at for r in rows] == [AT + dt.timedelta(days=n) for n in range(3)]
    for version in (0, 4):
        with pytest.raises(VersionGone):
            read_raw(spark, raw_dir, version)


def test_forgetting_keeps_every_readable_version(spark, three_loads, monkeypatch):
    raw_dir, counts = three_loads

    def interrupted(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "remove", interrupted)
        with pytest.raises(RuntimeError):
            forget_before(spark, raw_dir, 3)
    with pytest.raises(VersionGone):
        read_raw(spark, raw_dir, 2)
    gone = forget_before(spark, raw_dir, 3)
    assert len(gone) == 2 and all(path.endswith("/orders") for path in gone)
    found = read_raw(spark, raw_dir, 3)  # its customers came with the second load
    assert found["orders"].count() == counts[2] and found["users"].count() > 0
    assert forget_before(spark, raw_dir, 3) == []
    with pytest.raises(VersionGone):
        forget_before(spark, raw_dir, 99)


def test_loads_at_once_keep_each_other_s_tables(spark, sf_small, tmp_path, monkeypatch):
    tables, raw_dir = TestTables(spark, sf_small), str(tmp_path / "raw")
    for name in ("users", "orders"):
        write_csv_drop({name: tables[name]}, f"{tmp_path}/{name}")
    both, plain = Barrier(2, timeout=300), CommitLog.newest

    def together(self):
        found = plain(self)
        if found is None:
            both.wait()
        return found

    monkeypatch.setattr(CommitLog, "newest", together)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda n: load_raw(spark, f"{tmp_path}/{n}", raw_dir, AT),
                      ("users", "orders")))
    monkeypatch.setattr(CommitLog, "newest", plain)
    found = read_raw(spark, raw_dir)
    assert {n: f.count() for n, f in found.items()} == {
        n: tables[n].agg(F.count("*")).first()[0] for n in ("users", "orders")}
