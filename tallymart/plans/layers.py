"""The layers of the warehouse as lazily built DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import enrichment, staging
from tallymart.plans import marts
from tallymart.sources.exchange import export_parquet
from tallymart.specs import RAW_TABLES
from tallymart.workspace import scratch_dir, write_and_read

MARTS = ("fct_orders", "dim_customers", "dim_products", "fct_daily_kpis",
         "fct_revenue_recognition")

# The joins of lines shuffle them whole, so they are exported in slices of about so many.
ROWS_PER_SLICE = 50_000_000


class Layers:
    """Staging, intermediate and mart frames over a set of raw tables.

    Nothing runs until a frame is used. Frames share plans, not data: a job that reads several
    marts calls :meth:`with_written_orders` once, so that the order rollup is computed once.
    """

    def __init__(self, raw: Mapping[str, DataFrame], written_orders: DataFrame | None = None,
                 staged: Mapping[str, DataFrame] | None = None,
                 written_enriched: DataFrame | None = None, written_to: str | None = None):
        self.raw = raw
        self.written_to = written_to  # the folder of the written orders
        self._written_orders = written_orders
        self._written_enriched = written_enriched
        self._staged: dict[str, DataFrame] = dict(staged or {})  # tables that are written already

    def staged(self, table: str) -> DataFrame:
        if table not in self._staged:
            self._staged[table] = staging.STAGING[table](self.raw[table])
        return self._staged[table]

    @cached_property
    def line_enriched(self) -> DataFrame:
        return enrichment.line_enriched(
            self.staged("order_items"), self.staged("orders"), self.staged("products")
        )

    @cached_property
    def line_amounts(self) -> DataFrame:
        return enrichment.line_amounts(self.staged("order_items"), self.staged("products"))

    @cached_property
    def order_enriched(self) -> DataFrame:
        if self._written_enriched is not None:
            return self._written_enriched
        return enrichment.order_enriched(self.staged("orders"), self.line_amounts)

    @cached_property
    def fct_orders(self) -> DataFrame:
        if self._written_orders is not None:
            return self._written_orders
        return marts.fct_orders(self.order_enriched)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.staged("users"), self.fct_orders)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.staged("products"), self.staged("order_items"))

    @cached_property
    def fct_daily_kpis(self) -> DataFrame:
        return marts.fct_daily_kpis(self.fct_orders)

    @cached_property
    def fct_revenue_recognition(self) -> DataFrame:
        return marts.fct_revenue_recognition(self.fct_orders)

    def mart(self, name: str) -> DataFrame:
        if name not in MARTS:
            raise KeyError(name)
        return getattr(self, name)

    def over_staged(self, staged: Mapping[str, DataFrame]) -> Layers:
        """The same layers over staging tables that are written already."""
        return Layers(self.raw, self._written_orders, staged, self._written_enriched)

    def with_written_orders(self, name: str, whole: bool = False) -> Layers:
        """The same layers over a written copy of the order fact.

        With ``whole`` the copy has all columns of the enriched orders, which it then serves too.
        """
        if whole:
            path = scratch_dir(self.order_enriched.sparkSession, f"{name}/order_enriched")
            return Layers(self.raw, written_enriched=write_and_read(self.order_enriched, path),
                          written_to=path)
        path = scratch_dir(self.fct_orders.sparkSession, f"{name}/fct_orders")
        return Layers(self.raw, write_and_read(self.fct_orders, path), written_to=path)


def export_all(
    layers: Layers, target: str, done: Callable[[str], None] = lambda step: None
) -> list[tuple[str, str]]:
    """Export every table of the warehouse as ``<target>/<layer>/<table>``; returns their names.

    The exports of a step run as independent jobs, a few at a time. Staging reads the raw tables
    of the export, and later layers the exported staging tables, so that no join runs twice.
    ``done`` is told the steps "raw", "staging", "lines" (every slice), "orders" and "marts" as they
    end: raw frames are not read after "raw", and written orders not after "orders". The lines come
    before the orders, as their joins shuffle most and should meet the fewest tables on disk.
    """
    raw = _exported({("raw", name): layers.raw[name] for name in RAW_TABLES}, target)
    done("raw")
    views = Layers({name: raw["raw", name] for name in RAW_TABLES})
    staging_tables = _exported(
        {("staging", f"stg_{name}"): views.staged(name) for name in RAW_TABLES}, target)
    done("staging")
    staged = {name: staging_tables["staging", f"stg_{name}"] for name in RAW_TABLES}
    above = layers.over_staged(staged)
    lines = ("intermediate", "int_order_items_enriched")
    for number, part in enumerate(_slices(staged["order_items"])):
        sliced = layers.over_staged({**staged, "order_items": part}).line_enriched
        export_parquet({"/".join(lines): sliced}, target, **{"mode": "append"} if number else {})
        done("lines")
    orders = _exported({("intermediate", "int_orders_enriched"): above.order_enriched,
                        ("marts", "fct_orders"): above.fct_orders}, target)
    done("orders")
    over_orders = Layers(layers.raw, orders["marts", "fct_orders"], staged)
    rest = _exported(
        {("marts", name): over_orders.mart(name) for name in MARTS if name != "fct_orders"}, target)
    done("marts")
    return [*raw, *staging_tables, lines, *orders, *rest]


def _slices(items: DataFrame) -> Iterator[DataFrame]:
    """The lines in parts of about ``ROWS_PER_SLICE``; the lines of an order stay together."""
    number = -(-items.count() // ROWS_PER_SLICE)
    if number <= 1:
        yield items
        return
    for n in range(number):
        yield items.where(F.pmod(F.xxhash64("order_id"), F.lit(number)) == n)


def _exported(
    tables: Mapping[tuple[str, str], DataFrame], target: str
) -> dict[tuple[str, str], DataFrame]:
    """Export tables, and read them back."""
    export_parquet({f"{layer}/{name}": frame for (layer, name), frame in tables.items()}, target)
    return {
        (layer, name): frame.sparkSession.read.schema(frame.schema)
        .parquet(f"{target.rstrip('/')}/{layer}/{name}")
        for (layer, name), frame in tables.items()}
