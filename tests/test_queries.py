"""Every registered query against its DuckDB counterpart."""

import pytest

import __spark_entry__ as entry_module
from tallymart.counterparts import statements
from tallymart.plans.registry import registry
from tests.compare import connect, difference

QUERIES = registry()
ORACLE = statements()
# The smallest tables hold one duplicated line id, which closes the publication gate.
NEEDS_UNIQUE_LINES = {"publish_gate", "concurrent_publications"}


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_small, sf_medium, name):
    directory = sf_medium if name in NEEDS_UNIQUE_LINES else sf_small
    assert difference(QUERIES[name](spark, directory), connect(directory), ORACLE[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1094


def test_every_kind_of_check_meets_violations(spark, sf_medium):
    """Each kind of check has a query that finds offences, over the faulty feed."""
    for name in sorted(n for n in QUERIES if n.startswith("faulty_")):
        con = connect(sf_medium)
        expected = con.execute(ORACLE[name]).fetchall()
        columns = [d[0] for d in con.execute(ORACLE[name]).description]
        assert expected, name
        if "violations" in columns:
            at = columns.index("violations")
            assert any(row[at] > 0 for row in expected), name
        for column in ("mismatches", "below_cost", "negative_cost"):
            if column in columns:
                assert expected[0][columns.index(column)] > 0, name


@pytest.mark.parametrize("name", ["dashboard_kpis", "dq_not_null", "csv_scan", "export_marts"])
def test_scratch_data_of_two_calls_is_kept_apart(
    spark, sf_small, sf_medium, tmp_path, monkeypatch, name
):
    """Both results are built before either is read, with the cluster's shared folder set."""
    plain = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *default: (
        str(tmp_path) if key == "spark.checkpoint.dir" else plain(self, key, *default)))
    small, medium = QUERIES[name](spark, sf_small), QUERIES[name](spark, sf_medium)
    assert difference(small, connect(sf_small), ORACLE[name]) is None
    assert difference(medium, connect(sf_medium), ORACLE[name]) is None
    assert any(tmp_path.iterdir())
