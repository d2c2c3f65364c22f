"""Plans and results under conditions that only large data brings about."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tallymart import workspace
from tallymart.plans.registry import registry
from tallymart.session import initial_partitions, tune
from tallymart.plans.layers import Layers
from tallymart.sources.testdata import TestTables
from tests.compare import TABLES, connect, difference

QUERIES = registry()
ORACLE = entry_module.oracle_sql()

# Small thresholds make small data behave like large data.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.files.maxPartitionBytes": "256KB",
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture
def large(spark):
    """The session with broadcasts off and skew splitting from 64 KB on."""
    tune(spark)
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    before = {key: spark.conf.get(key, None) for key in LARGE}
    for key, value in LARGE.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "128MB")


@pytest.fixture(scope="module")
def hot(spark, sf_medium, tmp_path_factory):
    """Test tables in which a third of all lines share one order and product, and a third of all
    orders and events one customer."""
    folder = tmp_path_factory.mktemp("hot")
    third = F.expr("pmod(hash(*), 3) = 0")

    def heat(table, **keys):
        df = spark.read.parquet(f"{sf_medium}/{table}.parquet").withColumn("is_hot", third)
        for column, value in keys.items():
            kind = df.schema[column].dataType
            df = df.withColumn(
                column, F.when(F.col("is_hot"), F.lit(value).cast(kind)).otherwise(F.col(column)))
        df.drop("is_hot").repartition(12).write.parquet(f"{folder}/{table}.parquet")

    heat("lineitem", l_orderkey=5, l_partkey=3)
    heat("orders", o_custkey=11)
    heat("events", user_id=11)
    for table in TABLES:
        if table not in ("lineitem", "orders", "events"):
            (folder / f"{table}.parquet").symlink_to(f"{sf_medium}/{table}.parquet")
    return str(folder)


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("name", [
    "int_order_items_enriched", "int_orders_enriched", "dim_customers", "dim_products",
    "fct_daily_kpis", "monthly_repeat_rate", "category_growth", "dq_unique", "dq_relationships",
    "dq_status_agreement", "dq_price_ge_cost", "dq_item_count", "event_funnel_daily",
    "stg_inventory_items", "quality_report",
])
def test_hot_keys_do_not_change_results(large, hot, name):
    df = QUERIES[name](large, hot)
    assert difference(df, connect(hot), ORACLE[name]) is None


@pytest.mark.parametrize("name", ["int_order_items_enriched", "dq_price_ge_cost"])
def test_a_hot_partition_is_split(large, hot, name):
    df = QUERIES[name](large, hot)
    df.collect()
    assert "skew=true" in plan_of(df)


def test_a_hot_order_is_split_before_it_is_rolled_up(large, hot):
    df = Layers(TestTables(large, hot)).order_enriched
    df.collect()
    assert "skew=true" in plan_of(df)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {
    "csv_scan", "raw_audit", "load_report", "load_health", "export_marts", "publish_gate",
    "dashboard_payload", "quality_report", "defect_detection", "export_warehouse",
    "quality_report_json", "source_freshness", "dq_row_parity"}
    - {name for name in QUERIES if name.startswith("faulty_")}))
def test_plans_have_no_cross_join_and_no_python(spark, sf_small, name):
    plan = plan_of(QUERIES[name](spark, sf_small))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", plan)


def test_scans_read_only_what_a_query_needs(spark, sf_small):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES["monthly_revenue_trend"](spark, sf_small).explain("formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", out.getvalue())
    read = {field.split(":")[0] for schema in schemas for field in schema.split(",")}
    assert read == {"o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
                    "l_orderkey", "l_extendedprice"}


def test_unused_lookups_disappear(spark, sf_small):
    plan = plan_of(QUERIES["orders_by_status"](spark, sf_small))
    assert "Join" not in plan and plan.count("FileScan") == 1


def test_product_sales_join_no_lines(spark, sf_small):
    plan = plan_of(Layers(TestTables(spark, sf_small)).dim_products)
    top_join = plan.index("Join")
    assert "HashAggregate" in plan[top_join:]  # lines are combined below the catalogue join


def test_shuffle_parallelism_follows_the_input():
    assert initial_partitions(input_splits=8, configured=200) == 200
    assert initial_partitions(input_splits=8_000, configured=200) == 2_000
    assert initial_partitions(input_splits=800_000, configured=200) == 200_000
    assert initial_partitions(input_splits=800_000, configured=200, ceiling=50_000) == 50_000


def test_queries_leave_the_session_alone(spark, sf_small):
    before = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")}
    for name in ("fct_daily_kpis", "event_funnel_daily", "quality_report"):
        QUERIES[name](spark, sf_small).collect()
    after = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")}
    assert after == before


def test_daily_customers_travel_without_money(spark, sf_small):
    """Only (day, customer) is shuffled for the distinct count."""
    plan = plan_of(Layers(TestTables(spark, sf_small)).fct_daily_kpis)
    pairs = [line for line in plan.splitlines()
             if "Exchange hashpartitioning(order_date" in line and "user_id" in line]
    assert pairs and "Expand" not in plan


@pytest.mark.parametrize("master, alone", [
    ("local", True), ("local[8]", True), ("local[*]", True), ("local-cluster[3,2,1024]", False),
    ("yarn", False), ("spark://localhost:7077", False), ("", False)])
def test_temporary_folders_serve_one_process_alone(master, alone):
    assert workspace.one_machine(master) == alone
