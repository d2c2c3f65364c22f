"""What queries leave on disk, and how their layout follows the tables."""

import uuid
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tallymart.plans import layers, registry, upkeep
from tallymart.plans.bucketed import ROWS_PER_BUCKET, buckets_for
from tallymart.sources import exchange, testdata
from tallymart.sources.exchange import write_csv_drop
from tallymart.sources.landing import read_csv
from tallymart.specs import RAW_TABLES
from tests.frames import empty_raw


@pytest.fixture
def scratch(monkeypatch, tmp_path):
    """The folder that holds the scratch folders of the registered queries."""
    for module in (registry, upkeep, layers, testdata):
        monkeypatch.setattr(
            module, "scratch_dir", lambda spark, name: f"{tmp_path}/{uuid.uuid4().hex}/{name}")
    return Path(tmp_path)


def test_a_compressed_drop_reads_like_a_plain_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exchange, "ROWS_PER_COMPRESSED_PART", 2)
    schema = RAW_TABLES["distribution_centers"].schema
    centers = spark.createDataFrame(
        [(1, ' a, "b" ', 1.5, None), (2, None, 0.0, 1.0), (3, "", 1.0, 1.0)], schema).coalesce(1)
    found = {}
    for compressed in (False, True):
        write_csv_drop({"distribution_centers": centers}, f"{tmp_path}/{compressed}", compressed)
        folder = tmp_path / str(compressed) / "distribution_centers.csv"
        found[compressed] = sorted(map(tuple, read_csv(spark, str(folder), schema).collect()))
        ending = ".csv.gz" if compressed else ".csv"
        parts = list(folder.glob("part-*"))
        assert all(p.name.endswith(ending) for p in parts)
        assert len(parts) == (2 if compressed else 1)
    assert found[True] == found[False] and len(found[True]) == 3


def test_skipped_loads_leave_no_drop_and_one_batch_of_a_table(spark, sf_small, scratch):
    assert registry.freshness_after_skipped_loads(spark, sf_small).count() == 7
    assert not list(scratch.rglob("*.csv"))
    batches = [p.name for p in scratch.glob("*/skipped_loads/raw/batches/*/*")]
    assert sorted(batches) == sorted(RAW_TABLES)


def test_skipped_loads_count_the_lines_of_the_headers_once(spark, sf_small, scratch):
    registry.freshness_after_skipped_loads(spark, sf_small)
    written = spark.read.parquet(*map(str, scratch.glob("*/skipped_loads/orders")))
    expected = testdata.TestTables(spark, sf_small)["orders"]
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, expected.collect()))


def test_naive_times_are_dropped_as_they_are_cast_to_text(spark, tmp_path):
    texts = ["1994-01-02 03:04:05", "2024-02-29 23:59:59.000001", "0044-03-15 00:00:00.5", None]
    stamps = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "cast(t AS timestamp_ntz) AS t", "1 AS n").coalesce(1)
    write_csv_drop({"stamps": stamps}, str(tmp_path), compressed=True)
    folder = f"{tmp_path}/stamps.csv"
    assert [r.t for r in spark.read.csv(folder, header=True).collect()] == texts
    again = read_csv(spark, folder, "t timestamp_ntz, n int")
    assert [r.t for r in again.selectExpr("cast(t AS string) AS t").collect()] == texts


def test_keys_are_written_without_a_dictionary(spark, tmp_path):
    keys = spark.range(1000, numPartitions=1).selectExpr("id % 7 AS k", "cast(id % 7 AS string) AS s")
    exchange.export_parquet({"keys": keys}, str(tmp_path))
    part, = tmp_path.glob("keys/part-*.parquet")
    group = pq.read_metadata(part).row_group(0)
    found = {group.column(i).path_in_schema: set(group.column(i).encodings) for i in range(2)}
    assert "DELTA_BINARY_PACKED" in found["k"] and "RLE_DICTIONARY" not in found["k"]
    assert "RLE_DICTIONARY" in found["s"]


def test_the_export_leaves_nothing_beside_it(spark, sf_small, scratch):
    assert registry.export_warehouse(spark, sf_small).count() == 21
    assert {p.parent.name for p in scratch.glob("*/export_warehouse/*")} == {"export_warehouse"}
    assert {p.name for p in scratch.glob("*/export_warehouse/*")} == {"out"}


def test_lines_are_exported_in_slices(spark, sf_small, scratch, monkeypatch):
    whole = sorted(map(tuple, registry.export_warehouse(spark, sf_small).collect()))
    plain, = scratch.glob("*/export_warehouse/out")
    steps = []
    monkeypatch.setattr(layers, "ROWS_PER_SLICE", 2_000)
    monkeypatch.setattr(layers, "export_parquet", lambda frames, target, mode="overwrite": (
        steps.append((sorted(frames), mode)), exchange.export_parquet(frames, target, mode)))
    sliced = sorted(map(tuple, registry.export_warehouse(spark, sf_small).collect()))
    assert sliced == whole
    name = "intermediate/int_order_items_enriched"
    assert [mode for frames, mode in steps if name in frames] == ["overwrite", "append", "append"]
    other, = set(scratch.glob("*/export_warehouse/out")) - {plain}
    rows = [sorted(map(str, spark.read.parquet(f"{out}/{name}").collect())) for out in (plain, other)]
    assert rows[0] == rows[1] and rows[0]


@pytest.mark.parametrize("name", [
    "load_health", "dq_row_parity", "load_report", "raw_audit", "source_freshness"])
def test_landing_queries_write_compressed_files(spark, sf_small, scratch, name):
    assert registry.registry()[name](spark, sf_small).count() > 0
    parts = [p.name for p in scratch.rglob("*.csv/**/part-*")]
    assert parts and all(p.endswith(".csv.gz") for p in parts)
    landed = [p.name for p in scratch.rglob("raw/batches/**/part-*")]
    assert landed and all(p.endswith(".zstd.parquet") for p in landed)
    assert list(scratch.rglob("lines/part-*"))  # joined once for both tables of lines


def test_exported_layers_are_built_from_the_layer_before(spark, tmp_path, monkeypatch):
    frames = {}

    def export(tables, target):
        frames.update(tables)
        exchange.export_parquet(tables, target)

    monkeypatch.setattr(layers, "export_parquet", export)
    raw = empty_raw(spark)
    orders = layers.Layers(raw).with_written_orders("test_export", whole=True)
    assert orders.order_enriched.columns == layers.Layers(raw).order_enriched.columns
    assert orders.fct_orders.columns == layers.Layers(raw).fct_orders.columns
    names = layers.export_all(orders, str(tmp_path))
    assert len(names) == len(set(names)) == len(frames) == 21

    def read_from(frame):
        return {tuple(Path(f).parts[-3:-1]) for f in frame.inputFiles()}

    assert read_from(frames["staging/stg_inventory_items"]) == {("raw", "inventory_items")}
    assert read_from(frames["intermediate/int_order_items_enriched"]) == {
        ("staging", f"stg_{name}") for name in ("order_items", "orders", "products")}
    assert read_from(frames["intermediate/int_orders_enriched"]) == read_from(
        frames["marts/fct_orders"]) == {("test_export", "order_enriched")}


def test_buckets_follow_the_rows():
    assert buckets_for(0, at_least=8) == buckets_for(8 * ROWS_PER_BUCKET, at_least=8) == 8
    assert buckets_for(8 * ROWS_PER_BUCKET + 1, at_least=8) == 9
    for rows in (10**7, 10**9):
        assert rows / buckets_for(rows, at_least=8) <= ROWS_PER_BUCKET


@pytest.mark.parametrize("name", ["bucketed_customers", "bucketed_orders"])
def test_bucketed_queries_size_their_buckets(spark, sf_small, scratch, monkeypatch, name):
    monkeypatch.setattr("tallymart.plans.bucketed.ROWS_PER_BUCKET", 500)
    lines = spark.read.parquet(f"{sf_small}/lineitem.parquet").count()
    used = []

    def bucketed_layers(layers, database, root, buckets):
        used.append(buckets)
        return build(layers, database, root, buckets)

    build = upkeep.bucketed_layers
    monkeypatch.setattr(upkeep, "bucketed_layers", bucketed_layers)
    assert registry.registry()[name](spark, sf_small).count() > 0
    assert used == [-(-lines // 500)] and used[0] > upkeep.BUCKETS


def test_a_task_reads_a_bounded_number_of_lines(spark, sf_small, scratch, monkeypatch):
    monkeypatch.setattr("tallymart.plans.bucketed.ROWS_PER_BUCKET", 200)
    queries = registry.registry()
    plain, dealt = (sorted(map(str, queries[name](spark, sf_small).collect()))
                    for name in ("int_orders_enriched", "bucketed_orders"))
    assert dealt == plain and plain
    for table in ("stg_order_items", "stg_orders", "stg_users", "fct_orders"):
        rows = [pq.read_metadata(f).num_rows for f in scratch.rglob(f"{table}/part-*.parquet")]
        assert rows and max(rows) < 500, (table, rows)
