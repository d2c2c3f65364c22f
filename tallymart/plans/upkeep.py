"""Queries over the operators that keep tables up: increments, versions, changed days, layouts."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.governance.access import without_pii
from tallymart.governance.publish import GateClosed, publications, publish, read_run
from tallymart.operators.staging import COLUMNS, STAGING
from tallymart.plans import actives, refresh
from tallymart.plans.bucketed import bucketed_layers, buckets_for
from tallymart.plans.layers import MARTS, Layers
from tallymart.quality.checks import union_reports, write_checked
from tallymart.quality.suites import Bands, value_suites
from tallymart.sources.exchange import write_csv_drop
from tallymart.sources.landing import forget_before, load_raw, raw_versions, read_raw
from tallymart.sources.testdata import TestTables
from tallymart.streaming.events import closed_days, count_new_events
from tallymart.streaming.landing import land_new_files, read_landed
from tallymart.workspace import scratch_dir, side_by_side

Query = Callable[[SparkSession, str], DataFrame]

LANDED_AT = dt.datetime(2024, 2, 1, 6, 0, 0)
NEXT_DAY = LANDED_AT + dt.timedelta(days=1)
# From this day on, some orders come late and some come again with their lines.
LATE_FROM = dt.date(1998, 1, 1)
BUCKETS = 8


def incremental_landing(spark: SparkSession, directory: str) -> DataFrame:
    """Staged orders that were landed in two increments, with a restart between them and a third run
    that finds nothing new."""
    orders = TestTables(spark, directory)["orders"]
    drop = scratch_dir(spark, "incremental_landing/drop")
    raw_dir = scratch_dir(spark, "incremental_landing/raw")
    for name, part, at in (("first", "order_id % 4 <> 0", LANDED_AT),
                           ("second", "order_id % 4 = 0", NEXT_DAY)):
        write_csv_drop({"orders": orders.where(part)}, f"{drop}/{name}")
        land_new_files(spark, drop, raw_dir, "orders", at)
    land_new_files(spark, drop, raw_dir, "orders", NEXT_DAY + dt.timedelta(days=1))
    return read_landed(spark, raw_dir, "orders").select(
        *COLUMNS["orders"](), F.col("_loaded_at").alias("loaded_at"))


def event_counts_stream(spark: SparkSession, directory: str) -> DataFrame:
    """Events per closed day and type, from three drops; a tenth of the early events comes with the
    second one, and a tenth of all events with the last one."""
    events = TestTables(spark, directory)["events"]
    staged = STAGING["events"](events).select("event_id", "event_type", "created_at")
    seconds = F.unix_seconds(F.col("created_at").cast("timestamp"))
    middle = staged.agg(((F.min(seconds) + F.max(seconds)) / 2).cast("long")).first()[0]
    early = seconds < F.lit(middle)
    rest = F.col("event_id") % 10
    parts = [early & (rest > 1), (rest == 1) | (~early & (rest > 1)), rest == 0]
    drop, target = (scratch_dir(spark, f"event_counts_stream/{n}") for n in ("drop", "out"))
    for number, part in enumerate(parts):
        staged.where(part).drop("event_id").write.mode("append").parquet(drop)
        count_new_events(spark, drop, target)
    return closed_days(spark, target)


def raw_snapshots(spark: SparkSession, directory: str) -> DataFrame:
    """Rows and items of the orders in every version that can be read, after three loads, of which
    the first was forgotten."""
    orders = TestTables(spark, directory)["orders"]
    drop, raw_dir = (scratch_dir(spark, f"raw_snapshots/{n}") for n in ("drop", "raw"))
    for number in range(3):
        write_csv_drop({"orders": orders.where(f"order_id % 3 <> {number}")}, f"{drop}/{number}")
        load_raw(spark, f"{drop}/{number}", raw_dir, LANDED_AT + dt.timedelta(days=number))
    forget_before(spark, raw_dir, 2)
    return union_reports([
        read_raw(spark, raw_dir, row["version"])["orders"].agg(
            F.count("*").alias("rows"), F.sum("num_of_item").alias("items"),
            F.max("_loaded_at").alias("loaded_at"),
        ).select(F.lit(row["version"]).cast("long").alias("version"), "rows", "items", "loaded_at")
        for row in raw_versions(spark, raw_dir).collect()])


def concurrent_publications(bands: Bands) -> Query:
    """Orders and GMV of every version after two publishers ran at the same time."""
    def run(spark: SparkSession, directory: str) -> DataFrame:
        raw = dict(TestTables(spark, directory).with_written_lines("concurrent_publications").items())
        even = {**raw, **{t: raw[t].where("order_id % 2 = 0") for t in ("orders", "order_items")}}
        root = scratch_dir(spark, "concurrent_publications")

        def attempt(run_id: str, tables: dict[str, DataFrame]) -> None:
            try:
                publish(Layers(tables), root, run_id, LANDED_AT, bands)
            except GateClosed:
                pass  # such a version is missing from the result

        side_by_side(partial(attempt, run_id, tables)
                     for run_id, tables in (("all", raw), ("even", even)))
        log = publications(spark, root)
        entries = [log.read(version) for version in log.versions()]
        rows = [
            read_run(spark, root, entry["folder"])["fct_orders"].agg(
                F.count("*").alias("orders"), F.round(F.sum("gmv_amount"), 2).alias("gmv"),
            ).select(F.lit(entry["run_id"]).alias("run_id"), "orders", "gmv",
                     F.lit(len(entries)).cast("long").alias("versions"))
            for entry in entries]
        return union_reports(rows) if rows else spark.createDataFrame(
            [], "run_id string, orders bigint, gmv double, versions bigint")

    return run


def _refreshed(spark: SparkSession, directory: str, table: str) -> DataFrame:
    """A daily mart after a batch with late and completed orders; ``refreshed`` tells the months
    whose files were written anew."""
    orders = Layers(TestTables(spark, directory)).with_written_orders(f"refresh_{table}").fct_orders
    root = scratch_dir(spark, f"refresh_{table}/warehouse")
    recent = F.coalesce(F.col("order_date") >= F.lit(LATE_FROM), F.lit(False))
    late, unfinished = (recent & (F.col("order_id") % 7 == n) for n in (0, 1))
    money = [c for c, kind in orders.dtypes if kind == "double"]
    before = orders.where(~late).withColumns({
        **{c: F.when(unfinished, F.lit(0.0)).otherwise(F.col(c)) for c in money},
        "item_count": F.when(unfinished, F.lit(0).cast("long")).otherwise(F.col("item_count"))})
    refresh.build(before, root, "month")

    def files() -> list[str]:
        return refresh.read_by_period(spark, root, table).inputFiles()

    old = files()  # one per month
    refresh.refresh(orders.where(late | unfinished), root, "month")
    fresh = F.input_file_name().isin([f for f in files() if f not in set(old)])
    return refresh.read_by_period(spark, root, table).withColumn("refreshed", fresh).drop(
        refresh.PERIOD)


def marts_checked_while_written(bands: Bands) -> Query:
    """The value suites of the marts, from the jobs that wrote them."""
    def run(spark: SparkSession, directory: str) -> DataFrame:
        layers = Layers(TestTables(spark, directory)).with_written_orders("checked_while_written")
        root = scratch_dir(spark, "checked_while_written/marts")
        suites = {t: checks for t, checks in value_suites(bands).items() if t in MARTS}
        return union_reports(side_by_side(
            partial(write_checked, layers.mart(table), f"{root}/{table}", table, checks, "values")
            for table, checks in suites.items()))

    return run


def changed_days(table: str) -> Query:
    return lambda spark, directory: _refreshed(spark, directory, table)


def active_customers_by_period(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct customers per month, quarter, year and for all time, from written daily bitmaps."""
    orders = Layers(TestTables(spark, directory)).fct_orders
    path = scratch_dir(spark, "active_customers_by_period/daily")
    actives.daily_actives(orders).write.parquet(path)
    daily = spark.read.parquet(path)
    return union_reports([actives.active_customers(daily, grain)
                          for grain in ("month", "quarter", "year", "all")])


def _bucketed(spark: SparkSession, directory: str) -> Layers:
    root = scratch_dir(spark, "bucketed")
    tables = TestTables(spark, directory)
    rows = max(tables.read(name).count() for name in ("lineitem", "orders", "customer"))
    return bucketed_layers(Layers(tables), f"bucketed_{uuid.uuid4().hex}", root,
                           buckets_for(rows, at_least=BUCKETS))


def bucketed_orders(spark: SparkSession, directory: str) -> DataFrame:
    return _bucketed(spark, directory).order_enriched


def bucketed_customers(spark: SparkSession, directory: str) -> DataFrame:
    return _bucketed(spark, directory).dim_customers


def renamed_contacts(spark: SparkSession, directory: str) -> DataFrame:
    """Customers under other names, written and read back; the tags tell what may be shared."""
    customers = Layers(TestTables(spark, directory)).dim_customers.select(
        "user_id", F.col("email").alias("contact"), F.col("first_name").alias("salutation"),
        F.col("last_name").alias("surname"), "country", "customer_segment")
    path = scratch_dir(spark, "renamed_contacts")
    customers.write.parquet(path)
    return without_pii(spark.read.parquet(path))
