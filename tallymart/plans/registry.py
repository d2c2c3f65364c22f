"""Every operator as a named query over a directory of Parquet tables.

Each query is ``f(spark, directory) -> DataFrame`` over the whole tables. The library keeps money
and ratios unrounded; the queries round them (cents, six digits) so that results compare exactly.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.money import dollars
from tallymart.functions.timestamps import naive_literal, to_utc, utc_instant
from tallymart.governance.access import register_views, without_pii
from tallymart.governance.publish import GateClosed, live_marts, publish, resolver
from tallymart.operators.staging import STAGING
from tallymart.plans import business, metrics, upkeep
from tallymart.plans.layers import MARTS, Layers, export_all
from tallymart.plans.marts import dim_customers
from tallymart.quality import consistency
from tallymart.quality.checks import (
    REPORT_SCHEMA,
    Labelled,
    UniqueCheck,
    between,
    run_checks,
    run_labelled,
    union_reports,
)
from tallymart.quality.freshness import source_freshness
from tallymart.quality.mutation import detect_defects, standard_defects
from tallymart.quality.suites import (
    DAY_RULES,
    Bands,
    negative_prices,
    offending_days,
    run_contracts,
    run_value_suites,
    singular_checks,
    unreconciled_days,
    value_suites,
)
from tallymart.sources.commits import remove
from tallymart.sources.dirty import DirtyTables, spoiled_daily, spoiled_recognition
from tallymart.sources.exchange import export_parquet, write_csv_drop, write_json
from tallymart.sources.landing import (
    append_load_report,
    forget_before,
    load_health,
    load_raw,
    read_csv,
    read_raw,
    versions_of,
)
from tallymart.sources.testdata import TestTables
from tallymart.specs import RAW_TABLES
from tallymart.workspace import (
    release_shuffles,
    scratch_dir,
    side_by_side,
    write_and_read,
)

Query = Callable[[SparkSession, str], DataFrame]

MONEY = {
    "gmv", "gross_revenue", "net_revenue", "recognized_revenue", "refunds", "net_margin",
    "gmv_amount", "gross_amount", "net_amount", "refund_amount", "recognized_amount",
    "net_margin_amount", "processing_deferred", "net_revenue_mgmt", "recon_check",
    "lifetime_net_revenue", "unit_margin", "prior_net_revenue", "raw_total", "mart_total", "diff",
}
RATES = {
    "aov", "refund_rate", "net_margin_rate", "repeat_rate", "growth", "anonymous_share",
    "conversion_rate", "mean_net_revenue", "stddev_net_revenue",
}

# Ranges that suit the test tables.
TEST_BANDS = Bands(price_max=200_000, daily_net_max=50_000_000)
# The batch time of the landing queries and the clock of the freshness query.
BATCH_TIME = dt.datetime(2024, 2, 1, 6, 0, 0)
# Early enough for customers without an order, with one and with several.
SEGMENTS_AS_OF = dt.date(1996, 1, 1)
# Hours since each table was landed: within, on and beyond both thresholds.
LANDED_HOURS_AGO = {
    "distribution_centers": 25, "products": 27, "users": 49, "orders": 26,
    "order_items": 48, "inventory_items": 1, "events": 1,
}


def rounded(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Money to cents and ratios to six digits."""
    return df.select(*[
        dollars(F.col(c), 2).alias(c) if c in MONEY and c not in keep
        else F.round(c, 6).alias(c) if c in RATES and c not in keep
        else F.col(c)
        for c in df.columns
    ])


def _layers(spark: SparkSession, directory: str) -> Layers:
    return Layers(TestTables(spark, directory))


def _rounded(query: Query) -> Query:
    return lambda spark, directory: rounded(query(spark, directory))


def _over_layers(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, directory: rounded(build(_layers(spark, directory)))


def _as_built(build: Callable[[Layers], DataFrame]) -> Query:
    """For queries that round by themselves."""
    return lambda spark, directory: build(_layers(spark, directory))


def _over_written(
    name: str, build: Callable[[Layers], DataFrame], tables: type[TestTables] = TestTables
) -> Query:
    """For queries that read several tables of lines and marts: the joined lines and the order fact
    are written once and shared."""
    def run(spark: SparkSession, directory: str) -> DataFrame:
        raw = tables(spark, directory).with_written_lines(name)
        return build(Layers(raw).with_written_orders(name))

    return run


def _over_faulty(name: str, build: Callable[[Layers], DataFrame]) -> Query:
    return _over_written(f"faulty_{name}", build, DirtyTables)


# --- sources and sinks ---------------------------------------------------------------------------


def _dropped(spark: SparkSession, directory: str, name: str, tables: Sequence[str]) -> str:
    """A CSV drop of some raw tables in the scratch folder, with compressed parts."""
    raw = TestTables(spark, directory)
    if {"order_items", "inventory_items"} <= set(tables):
        raw = raw.with_written_lines(name)
    target = scratch_dir(spark, f"{name}/drop")
    write_csv_drop({t: raw[t] for t in tables}, target, compressed=True)
    return target


def csv_scan(spark: SparkSession, directory: str) -> DataFrame:
    """Order lines written as CSV, read back with declared types and staged."""
    drop = _dropped(spark, directory, "csv_scan", ["order_items"])
    raw = read_csv(spark, f"{drop}/order_items.csv", RAW_TABLES["order_items"].schema)
    return STAGING["order_items"](raw)


def raw_audit(spark: SparkSession, directory: str) -> DataFrame:
    """Audit columns of every landed table."""
    drop = _dropped(spark, directory, "raw_audit", list(RAW_TABLES))
    raw_dir = scratch_dir(spark, "raw_audit/raw")
    load_raw(spark, drop, raw_dir, BATCH_TIME, strict=True)
    return union_reports([
        frame.agg(
            F.count("*").alias("rows"),
            F.min("_loaded_at").alias("first_loaded_at"),
            F.max("_loaded_at").alias("last_loaded_at"),
            F.count_if((F.col("_source_file") == f"{name}.csv")
                       & F.col("_source_part").rlike(r"\.csv(\.gz)?$")).alias("rows_with_source"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, frame in read_raw(spark, raw_dir).items()
    ])


def load_report(spark: SparkSession, directory: str) -> DataFrame:
    """The report of landing all tables."""
    drop = _dropped(spark, directory, "load_report", list(RAW_TABLES))
    return load_raw(spark, drop, scratch_dir(spark, "load_report/raw"), BATCH_TIME, strict=True)


def load_health_log(spark: SparkSession, directory: str) -> DataFrame:
    """Row counts of two runs over all tables, the first of them repeated; the second one comes
    without the cancelled orders."""
    drop = _dropped(spark, directory, "load_health", list(RAW_TABLES))
    raw_dir, log = scratch_dir(spark, "load_health/raw"), scratch_dir(spark, "load_health/log")
    report = load_raw(spark, drop, raw_dir, BATCH_TIME)
    append_load_report(report, "run-0", log)
    append_load_report(report, "run-0", log)
    orders = TestTables(spark, directory)["orders"].filter("status <> 'Cancelled'")
    write_csv_drop({"orders": orders}, drop, compressed=True)
    next_day = BATCH_TIME + dt.timedelta(days=1)
    append_load_report(load_raw(spark, drop, raw_dir, next_day), "run-1", log)
    return load_health(spark.read.parquet(log))


def landed_by_age(spark: SparkSession, directory: str) -> DataFrame:
    """Freshness of tables that were landed at different times."""
    tables = TestTables(spark, directory).with_written_lines("freshness")
    drop, raw_dir = scratch_dir(spark, "freshness/drop"), scratch_dir(spark, "freshness/raw")
    for name in RAW_TABLES:
        write_csv_drop({name: tables[name]}, f"{drop}/{name}", compressed=True)
        landed_at = BATCH_TIME - dt.timedelta(hours=LANDED_HOURS_AGO[name])
        load_raw(spark, f"{drop}/{name}", raw_dir, landed_at)
    return source_freshness(read_raw(spark, raw_dir), BATCH_TIME)


def freshness_after_skipped_loads(spark: SparkSession, directory: str) -> DataFrame:
    """Freshness after four daily loads, the last one two days after the newest unit came into stock.

    The first load brings every table, the others those with a row created on the day before; what
    has not changed is skipped and keeps its age. Every drop holds what was created until then. A
    drop is deleted once it is landed, and raw tables once a later load has replaced them.
    """
    tables = dict(TestTables(spark, directory).with_written_lines("skipped_loads"))
    # Every drop holds the headers, whose lines are counted once.
    tables["orders"] = write_and_read(
        tables["orders"], scratch_dir(spark, "skipped_loads/orders"))
    release_shuffles(spark)
    created = F.col("created_at")
    day = F.to_date(to_utc(created))
    dated = [name for name in RAW_TABLES if "created_at" in tables[name].columns]
    newest = tables["inventory_items"].agg(F.max(created).alias("created_at")).select(
        day).first()[0] or BATCH_TIME.date()
    days = [newest + dt.timedelta(days=n) for n in (-1, 0, 1, 2)]
    changes = dict(zip(dated, side_by_side(
        tables[name].where((created >= _midnight(days[0])) & (created < _midnight_after(days[-1])))
        .select(day.alias("day")).distinct().collect
        for name in dated)))
    raw_dir = scratch_dir(spark, "skipped_loads/raw")
    for today in days:
        changed = [name for name in dated if today in {r["day"] for r in changes[name]}]
        drop = scratch_dir(spark, "skipped_loads/drop")
        frames = {
            name: tables[name].where(created < _midnight_after(today))
            if name in dated else tables[name]
            for name in (RAW_TABLES if today == days[0] else changed)}
        if frames:
            write_csv_drop(frames, drop, compressed=True)
            release_shuffles(spark)
            load_raw(spark, drop, raw_dir, _morning_after(today))
            remove(spark, drop)
            forget_before(spark, raw_dir, versions_of(spark, raw_dir).newest()["version"])
    return source_freshness(read_raw(spark, raw_dir), _morning_after(days[-1]))


def _midnight(day: dt.date) -> Column:
    """The instant at which a UTC day begins."""
    return utc_instant(naive_literal(dt.datetime.combine(day, dt.time.min)))


def _midnight_after(day: dt.date) -> Column:
    return _midnight(day + dt.timedelta(days=1))


def _morning_after(day: dt.date) -> dt.datetime:
    return dt.datetime.combine(day + dt.timedelta(days=1), BATCH_TIME.time())


def row_parity(spark: SparkSession, directory: str) -> DataFrame:
    """Rows of the landed tables against those of their staging views, which were written."""
    drop = _dropped(spark, directory, "row_parity", list(RAW_TABLES))
    raw_dir, out = scratch_dir(spark, "row_parity/raw"), scratch_dir(spark, "row_parity/staged")
    load_raw(spark, drop, raw_dir, BATCH_TIME, strict=True)
    raw = read_raw(spark, raw_dir)
    export_parquet({name: STAGING[name](frame) for name, frame in raw.items()}, out)
    return consistency.row_parity(
        raw, {name: spark.read.parquet(f"{out}/{name}") for name in raw})


def export_marts(spark: SparkSession, directory: str) -> DataFrame:
    """Rows per exported mart."""
    layers = _layers(spark, directory).with_written_orders("export_marts")
    target = scratch_dir(spark, "export_marts/out")
    export_parquet({m: layers.mart(m) for m in MARTS}, target)
    return _mart_rows({m: spark.read.parquet(f"{target}/{m}") for m in MARTS})


# One column of every exported table, whose sum tells the content.
CONTENT = {
    "distribution_centers": "latitude", "products": "retail_price", "users": "age",
    "orders": "num_of_item", "order_items": "sale_price", "inventory_items": "cost",
    "events": "sequence_number", "int_order_items_enriched": "net_amount",
    "int_orders_enriched": "num_of_item", "fct_orders": "gmv_amount",
    "dim_customers": "lifetime_net_revenue", "dim_products": "net_revenue",
    "fct_daily_kpis": "net_revenue", "fct_revenue_recognition": "recognized_revenue",
}


def export_warehouse(spark: SparkSession, directory: str) -> DataFrame:
    """Rows and content of every exported table of every layer, read back from the export.

    What is written besides the export is deleted as soon as no later step reads it.
    """
    raw = TestTables(spark, directory).with_written_lines("export_warehouse")
    release_shuffles(spark)
    layers = Layers(raw).with_written_orders("export_warehouse", whole=True)
    release_shuffles(spark)
    target = scratch_dir(spark, "export_warehouse/out")
    last_read = {"raw": raw.written_to, "orders": layers.written_to}

    def tidy(step: str) -> None:
        if step in last_read:
            remove(spark, last_read[step])
        release_shuffles(spark)

    names = export_all(layers, target, tidy)
    return union_reports([
        spark.read.parquet(f"{target}/{layer}/{name}")
        .agg(F.count("*").alias("rows"), F.round(F.sum(
            F.col(CONTENT[name.removeprefix("stg_")]).cast("double")), 2).alias("content"))
        .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows", "content")
        for layer, name in names
    ])


def publish_gate(spark: SparkSession, directory: str) -> DataFrame:
    """Rows and GMV of the live marts after a publication whose retry, under the same run id, came
    with impossible prices; nothing if the first gate stayed closed."""
    layers = _layers(spark, directory)
    root = scratch_dir(spark, "publish_gate")
    try:
        publish(layers, root, "run-1", BATCH_TIME, TEST_BANDS)
    except GateClosed:
        return spark.createDataFrame([], "mart string, rows bigint, gmv double, retry string")
    broken = dict(layers.raw.items())
    broken["order_items"] = broken["order_items"].withColumn(
        "sale_price", F.expr("if(order_id % 1000 = 7, -5000000D, sale_price)"))
    try:
        publish(Layers(broken), root, "run-1", BATCH_TIME, TEST_BANDS)
        retry = "open"
    except GateClosed:
        retry = "closed"
    totals = {"fct_orders": "gmv_amount", "fct_daily_kpis": "gmv"}
    return union_reports([
        frame.agg(
            F.count("*").alias("rows"),
            (dollars(F.sum(totals[name]), 2) if name in totals else F.lit(None).cast("double"))
            .alias("gmv"),
        ).select(F.lit(name).alias("mart"), "rows", "gmv", F.lit(retry).alias("retry"))
        for name, frame in live_marts(spark, root).items()
    ])


def _mart_rows(marts: dict[str, DataFrame]) -> DataFrame:
    return union_reports([
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("mart"), "rows")
        for name, frame in marts.items()
    ])


def offsets_to_utc(spark: SparkSession, directory: str) -> DataFrame:
    """Order times written with three different offsets, normalised to naive UTC."""
    orders = TestTables(spark, directory).read("orders")
    offset = F.expr("elt(cast(1 + o_orderkey % 3 AS int), '+00:00', '-05:00', '+05:30')")
    text = F.concat(F.col("o_orderdate").cast("string"), offset)
    return orders.select("o_orderkey", to_utc(text).alias("utc_time"))


# --- quality -------------------------------------------------------------------------------------


CONTRACT_QUERIES = ("not_null", "unique", "accepted_values", "relationships")


def _contracts(kind: str) -> Callable[[Layers], DataFrame]:
    return lambda layers: run_contracts(resolver(layers), (kind,))


def _contract_kind(kind: str) -> Query:
    # Only keys and NULL counts touch both tables of lines and several marts.
    if kind in ("not_null", "unique"):
        return _over_written(f"dq_{kind}", _contracts(kind))
    return _as_built(_contracts(kind))


def _spoiled(layers: Layers) -> dict[str, DataFrame]:
    """The daily and finance marts with faults that no feed can bring about."""
    return {"fct_daily_kpis": spoiled_daily(layers.fct_daily_kpis),
            "fct_revenue_recognition": spoiled_recognition(layers.fct_revenue_recognition)}


def _faulty_rule(table: str, name: str) -> Query:
    def build(layers: Layers) -> DataFrame:
        checks = [c for c in value_suites()[table] if c.name == f"rule:{name}"]
        return run_checks(_spoiled(layers)[table], table, checks, "values")

    return _over_faulty(f"rule_{name}", build)


def unreconciled(layers: Layers) -> DataFrame:
    days = unreconciled_days(_spoiled(layers)["fct_revenue_recognition"])
    return days.select("order_date", *[dollars(F.col(c), 2).alias(c) for c in (
        "net_revenue_mgmt", "recon_check", "diff")])


def faulty_queries() -> dict[str, Query]:
    """The checks over a feed with faults, and the offending rows themselves."""
    def singular(layers: Layers, table: str) -> DataFrame:
        frame = _spoiled(layers).get(table)
        if frame is None:
            frame = resolver(layers)(table)
        return run_checks(frame, table, singular_checks()[table], "singular")

    builds: dict[str, Callable[[Layers], DataFrame]] = {
        **{f"dq_{kind}": _contracts(kind) for kind in CONTRACT_QUERIES},
        "dq_negative_price": lambda x: singular(x, "stg_order_items"),
        "dq_revenue_reconciles": lambda x: singular(x, "fct_revenue_recognition"),
        "dq_status_agreement":
            lambda x: consistency.status_agreement(x.staged("order_items"), x.staged("orders")),
        "dq_conditional_null": lambda x: consistency.conditional_nulls(x.staged("orders")),
        "dq_price_ge_cost":
            lambda x: consistency.price_covers_cost(x.staged("order_items"), x.staged("products")),
        "dq_item_count":
            lambda x: consistency.item_counts(x.staged("orders"), x.staged("order_items")),
        "negative_price_rows": lambda x: negative_prices(x.staged("order_items")),
        "unreconciled_days": unreconciled,
        "offending_days": lambda x: offending_days(_spoiled(x).__getitem__),
    }
    rules = {f"rule_{name}": _faulty_rule(table, name) for name, (table, _) in DAY_RULES.items()}
    return {f"faulty_{name}": query for name, query in {
        **{name: _over_faulty(name, build) for name, build in builds.items()}, **rules}.items()}


def _suite_rule(table: str, name: str) -> Query:
    def build(layers: Layers) -> DataFrame:
        checks = [c for c in value_suites()[table] if c.name == f"rule:{name}"]
        return run_checks(layers.mart(table), table, checks, "values")

    return _as_built(build)


def _singular(table: str) -> Query:
    return _as_built(
        lambda layers: run_checks(
            resolver(layers)(table), table, singular_checks()[table], "singular")
    )


def unique_rows(layers: Layers) -> DataFrame:
    """Rows that share their value, for the declared keys and for one column that repeats."""
    frame = resolver(layers)
    columns = [("stg_order_items", "order_item_id"), ("fct_daily_kpis", "order_date"),
               ("dim_customers", "user_id"), ("fct_revenue_recognition", "order_date"),
               ("stg_orders", "user_id")]
    return union_reports([
        run_checks(frame(table), table, [UniqueCheck(column)], "values")
        for table, column in columns
    ])


def ranges(layers: Layers) -> DataFrame:
    """Inclusive ranges with two, one or no offended bound."""
    return union_reports([
        run_checks(layers.staged("order_items"), "stg_order_items",
                   [between("sale_price", 0, 50_000)], "values"),
        run_checks(layers.fct_daily_kpis, "fct_daily_kpis", [
            between("net_revenue", 0), between("active_customers", 0),
            between("refund_rate", 0, 1), between("net_margin_rate", 0, 1),
            between("net_orders", 5),
        ], "values"),
        run_checks(layers.dim_customers, "dim_customers",
                   [between("lifetime_net_orders", None, 12)], "values"),
    ])


def tolerated_ranges(layers: Layers) -> DataFrame:
    """Price bands with a tolerance: one that holds although some lines lie outside, one that does
    not."""
    bands = {"values": 104_200, "values_tight": 90_000}
    checks = [Labelled(suite, "stg_order_items", between("sale_price", 0, high, mostly=0.99))
              for suite, high in bands.items()]
    return run_labelled(layers.staged("order_items"), checks)


def defects_over_written(layers: Layers) -> DataFrame:
    """Defect detection over written tables: each is read for its keys and for its checks."""
    target = scratch_dir(layers.fct_orders.sparkSession, "defect_detection/tables")
    tables = [d.table for d in standard_defects()]
    frames = {name: resolver(layers)(name) for name in dict.fromkeys(tables)}
    # The staged lines are a view of the written lines already.
    export_parquet({n: f for n, f in frames.items() if not n.startswith("stg_")}, target)
    spark = layers.fct_orders.sparkSession
    return detect_defects(
        lambda n: frames[n] if n.startswith("stg_") else spark.read.parquet(f"{target}/{n}"),
        bands=TEST_BANDS)


def role_view(role: str, subject: str) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        register_views(role, _layers(spark, directory).mart)
        return rounded(spark.table(f"{role}_{subject}"))

    return run


def dashboard_kpis(spark: SparkSession, directory: str) -> DataFrame:
    """The card row over the written order fact, which both marts are built from."""
    layers = _layers(spark, directory).with_written_orders("dashboard_kpis")
    return rounded(business.dashboard_kpis(layers.fct_daily_kpis, layers.dim_customers))


def dashboard_payload(spark: SparkSession, directory: str) -> DataFrame:
    """The dashboard document, written as JSON and read back with its main fields."""
    layers = _layers(spark, directory).with_written_orders("dashboard_payload")
    target = scratch_dir(spark, "dashboard_payload/json")
    write_json(
        business.dashboard_payload(
            layers.fct_orders, layers.fct_daily_kpis, layers.dim_products, layers.dim_customers),
        target,
    )
    amounts = ("net_revenue", "recognized_revenue", "gmv", "refunds")
    rates = ("aov", "repeat_rate", "refund_rate", "net_margin_rate")
    labels = ("month", "category", "department", "traffic_source", "brand", "status")
    fields = F.from_json("record", ", ".join([
        *[f"{c} string" for c in (*labels, "date_min", "date_max")],
        *[f"{c} bigint" for c in ("orders", "net_orders", "purchasers")],
        *[f"{c} double" for c in (*amounts, *rates)],
    ]))
    return (
        spark.read.schema("section string, position int, record string").json(target)
        .withColumn("fields", fields)
        .select(
            "section", "position",
            F.coalesce(*[F.col(f"fields.{c}") for c in labels]).alias("label"),
            "fields.orders", "fields.net_orders", "fields.purchasers",
            *[dollars(F.col(f"fields.{c}"), 2).alias(c) for c in amounts],
            *[F.round(f"fields.{c}", 6).alias(c) for c in rates],
            "fields.date_min", "fields.date_max",
        )
    )


def quality_report_json(spark: SparkSession, directory: str) -> DataFrame:
    """The quality report, written as a JSON document and read back."""
    report = quality_report(spark, directory)
    target = scratch_dir(spark, "quality_report_json/json")
    write_json(report, target)
    return spark.read.schema(REPORT_SCHEMA).json(target)


quality_report = _over_written(
    "quality_report", lambda x: run_value_suites(resolver(x), TEST_BANDS))


def registry() -> dict[str, Query]:
    staged = {f"stg_{name}": _over_layers(lambda layers, name=name: layers.staged(name))
              for name in STAGING}
    marts = {name: _over_layers(lambda layers, name=name: layers.mart(name)) for name in MARTS}
    contract_kinds = {
        f"dq_{kind}": _contract_kind(kind)
        for kind in CONTRACT_QUERIES
    }
    return {
        # sources and sinks
        "csv_scan": csv_scan,
        "raw_audit": raw_audit,
        "load_report": load_report,
        "load_health": load_health_log,
        "export_marts": export_marts,
        "export_warehouse": export_warehouse,
        "publish_gate": publish_gate,
        "to_utc": offsets_to_utc,
        "incremental_landing": upkeep.incremental_landing,
        "raw_snapshots": upkeep.raw_snapshots,
        "concurrent_publications": upkeep.concurrent_publications(TEST_BANDS),
        # layers
        **staged,
        "int_order_items_enriched": _over_layers(lambda layers: layers.line_enriched),
        "int_orders_enriched": _over_layers(lambda layers: layers.order_enriched),
        "revenue_ladder": _over_layers(
            lambda layers: metrics.line_revenue(
                layers.line_enriched, "month", ["department", "status"])),
        **marts,
        "changed_days_kpis": _rounded(upkeep.changed_days("fct_daily_kpis")),
        "changed_days_recognition": _rounded(upkeep.changed_days("fct_revenue_recognition")),
        "bucketed_orders": _rounded(upkeep.bucketed_orders),
        "bucketed_customers": _rounded(upkeep.bucketed_customers),
        # business questions
        "headline_kpis": _as_built(lambda x: business.headline_kpis(x.fct_daily_kpis)),
        "monthly_revenue_trend": _as_built(
            lambda x: business.monthly_revenue_trend(x.fct_daily_kpis)),
        "revenue_by_category": _as_built(lambda x: business.revenue_by_category(x.dim_products)),
        "repeat_purchase_rate": _as_built(
            lambda x: business.repeat_purchase_rate(x.dim_customers)),
        "monthly_recognition": _as_built(
            lambda x: business.monthly_recognition(x.fct_revenue_recognition)),
        "orders_by_status": _as_built(lambda x: business.orders_by_status(x.fct_orders)),
        "top_customers_ltv": _as_built(lambda x: business.top_customers_ltv(x.dim_customers)),
        "customer_segments": _over_layers(lambda x: business.customer_segments(x.dim_customers)),
        "customer_segments_as_of": _over_layers(lambda x: business.customer_segments(
            dim_customers(x.staged("users"), x.fct_orders, SEGMENTS_AS_OF))),
        "dashboard_kpis": dashboard_kpis,
        "dashboard_monthly": _as_built(lambda x: business.dashboard_monthly(x.fct_daily_kpis)),
        "monthly_by_year": _as_built(
            lambda x: business.dashboard_monthly(x.fct_daily_kpis, 1997)),
        "dashboard_years": _as_built(lambda x: business.dashboard_years(x.fct_daily_kpis)),
        "top_categories": _as_built(lambda x: business.top_categories(x.dim_products)),
        "top_three_categories": _as_built(
            lambda x: business.revenue_by(x.dim_products, "category", top=3)),
        "revenue_by_department": _as_built(
            lambda x: business.revenue_by_department(x.dim_products)),
        "revenue_by_traffic_source": _as_built(
            lambda x: business.revenue_by_traffic_source(x.dim_customers)),
        "top_brands": _as_built(lambda x: business.top_brands(x.dim_products)),
        "dashboard_payload": dashboard_payload,
        # quality
        **contract_kinds,
        "dq_unique_rows": _as_built(unique_rows),
        "dq_between": _as_built(ranges),
        "dq_between_mostly": _as_built(tolerated_ranges),
        "dq_negative_price": _singular("stg_order_items"),
        "dq_revenue_reconciles": _singular("fct_revenue_recognition"),
        "rule_ladder_order": _suite_rule("fct_daily_kpis", "ladder_order"),
        "rule_recognized_le_net": _suite_rule("fct_daily_kpis", "recognized_le_net"),
        "rule_active_le_orders": _suite_rule("fct_daily_kpis", "active_le_orders"),
        "rule_finance_recon": _suite_rule("fct_revenue_recognition", "finance_recon"),
        **faulty_queries(),
        "source_freshness": landed_by_age,
        "freshness_after_skipped_loads": freshness_after_skipped_loads,
        "quality_report": quality_report,
        "quality_report_json": quality_report_json,
        "marts_checked_while_written": upkeep.marts_checked_while_written(TEST_BANDS),
        "defect_detection": _over_written("defect_detection", defects_over_written),
        "dq_status_agreement": _as_built(
            lambda x: consistency.status_agreement(x.staged("order_items"), x.staged("orders"))),
        "dq_row_parity": row_parity,
        "dq_conditional_null": _as_built(
            lambda x: consistency.conditional_nulls(x.staged("orders"))),
        "dq_mart_raw_recon": _over_layers(
            lambda x: consistency.mart_raw_reconciliation(
                x.raw["order_items"], x.fct_daily_kpis)),
        "dq_price_ge_cost": _as_built(
            lambda x: consistency.price_covers_cost(
                x.staged("order_items"), x.staged("products"))),
        "dq_item_count": _as_built(
            lambda x: consistency.item_counts(x.staged("orders"), x.staged("order_items"))),
        # metrics
        "order_kpis_monthly": _over_layers(
            lambda x: metrics.order_kpis(x.fct_orders, "month", ["status"])),
        "refund_rate_by_count": _over_layers(
            lambda x: metrics.refund_rate_by_count(x.staged("order_items"))),
        "monthly_aov": _over_layers(lambda x: metrics.monthly_aov(x.fct_orders)),
        "monthly_active_customers": _over_layers(
            lambda x: metrics.monthly_active_customers(x.fct_orders)),
        "active_customers_by_period": upkeep.active_customers_by_period,
        "monthly_repeat_rate": _over_layers(lambda x: metrics.monthly_repeat_rate(x.fct_orders)),
        "category_growth": _over_layers(lambda x: metrics.category_growth(x.line_enriched)),
        "recognition_by_ship_date": _over_layers(
            lambda x: metrics.recognition_by_ship_date(x.staged("order_items"))),
        "revenue_drop_alert": _over_layers(
            lambda x: metrics.revenue_drop_alert(x.fct_daily_kpis)),
        "revenue_drop_alert_tight": _over_layers(
            lambda x: metrics.revenue_drop_alert(x.fct_daily_kpis, days=7, sigmas=1.0)),
        "event_funnel_daily": _over_layers(
            lambda x: metrics.event_funnel_daily(x.staged("events"))),
        "event_counts_stream": upkeep.event_counts_stream,
        "daily_conversion": _over_layers(lambda x: metrics.daily_conversion(x.staged("events"))),
        # governance
        "customers_no_pii": _over_layers(lambda x: without_pii(x.dim_customers)),
        "renamed_contacts": upkeep.renamed_contacts,
        "marketing_view": role_view("marketing", "daily_kpis"),
        "finance_view": role_view("finance", "revenue_recognition"),
    }
