"""Which checks apply to which table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.staging import beside_raw, raw_alias
from tallymart.quality.checks import (
    KEYED_TABLES,
    Check,
    Labelled,
    RowCheck,
    UniqueCheck,
    accepted_values,
    between,
    not_null,
    rule,
    run_checks,
    run_labelled,
    run_reference_check,
    union_reports,
)
from tallymart.specs import CUSTOMER_SEGMENTS, ORDER_STATUSES, RAW_TABLES

# Looks up a table by its qualified name.
Frames = Callable[[str], DataFrame]

# Money totals are compared with a sub-cent tolerance.
TOLERANCE = 0.01


@dataclass(frozen=True)
class Bands:
    """Plausible ranges that depend on the business behind the data (defaults are fixed values)."""

    price_max: float = 2000
    daily_net_max: float = 250_000
    daily_net_mostly: float = 0.99


def ladder_ordered() -> Column:
    return (F.col("gmv") >= F.col("gross_revenue")) & (
        F.col("gross_revenue") >= F.col("net_revenue")
    )


def recognized_within_net() -> Column:
    return F.col("recognized_revenue") <= F.col("net_revenue") + TOLERANCE


def active_within_orders() -> Column:
    return F.col("active_customers") <= F.col("net_orders")


def finance_reconciles() -> Column:
    return F.abs(F.col("net_revenue_mgmt") - F.col("recon_check")) <= TOLERANCE


def value_suites(bands: Bands = Bands()) -> dict[str, list[Check]]:
    """Value and distribution checks of the published tables, with their row invariants."""
    return {
        "stg_order_items": [
            not_null("order_item_id"),
            UniqueCheck("order_item_id"),
            not_null("sale_price"),
            between("sale_price", 0, bands.price_max),
            accepted_values("status", ORDER_STATUSES),
        ],
        "fct_daily_kpis": [
            not_null("order_date"),
            UniqueCheck("order_date"),
            not_null("net_revenue"),
            between("net_revenue", 0),
            between("net_orders", 0),
            between("active_customers", 0),
            between("refund_rate", 0, 1),
            between("net_margin_rate", 0, 1),
            between("net_revenue", 0, bands.daily_net_max, mostly=bands.daily_net_mostly),
            rule("ladder_order", ladder_ordered(), "net_revenue"),
            rule("recognized_le_net", recognized_within_net(), "recognized_revenue"),
            rule("active_le_orders", active_within_orders(), "active_customers"),
        ],
        "dim_customers": [
            not_null("user_id"),
            UniqueCheck("user_id"),
            between("lifetime_net_orders", 0),
            accepted_values("customer_segment", CUSTOMER_SEGMENTS),
        ],
        "fct_revenue_recognition": [
            not_null("order_date"),
            UniqueCheck("order_date"),
            between("recognized_revenue", 0),
            rule("finance_recon", finance_reconciles(), "recon_check"),
        ],
    }


def run_value_suites(
    tables: Mapping[str, DataFrame] | Callable[[str], DataFrame], bands: Bands = Bands()
) -> DataFrame:
    """Report over all value suites; ``tables`` maps or resolves a table name to its frame."""
    frame = tables if callable(tables) else tables.__getitem__
    return union_reports(
        [run_checks(frame(name), name, checks, "values")
         for name, checks in value_suites(bands).items()]
    )


@dataclass(frozen=True)
class Contract:
    """Declared keys, required columns, enumerations and references of one table."""

    keys: tuple[str, ...]
    required: tuple[str, ...]
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()

    def not_null_checks(self) -> list[RowCheck]:
        return [not_null(c) for c in self.required]

    def unique_checks(self) -> list[UniqueCheck]:
        return [UniqueCheck(c, per_value=True) for c in self.keys]

    def accepted_checks(self) -> list[RowCheck]:
        return [accepted_values(c, values) for c, values in self.accepted]

    def checks(self, kinds: tuple[str, ...]) -> list[Check]:
        return [
            *(self.not_null_checks() if "not_null" in kinds else []),
            *(self.unique_checks() if "unique" in kinds else []),
            *(self.accepted_checks() if "accepted_values" in kinds else []),
        ]


def _raw_contract(name: str) -> Contract:
    spec = RAW_TABLES[name]
    return Contract(
        keys=(spec.key,),
        required=(spec.key,),
        accepted=tuple(spec.accepted.items()),
        references=tuple((r.column, f"raw.{r.parent}", r.parent_column)
                         for r in spec.references),
    )


CONTRACTS: dict[str, Contract] = {
    **{f"raw.{name}": _raw_contract(name) for name in RAW_TABLES},
    "stg_distribution_centers": Contract(
        ("distribution_center_id",), ("distribution_center_id",)),
    "stg_products": Contract(("product_id",), ("product_id", "retail_price")),
    "stg_users": Contract(("user_id",), ("user_id", "created_at")),
    "stg_orders": Contract(
        ("order_id",), ("order_id", "user_id", "created_at"),
        accepted=(("status", ORDER_STATUSES),)),
    "stg_order_items": Contract(
        ("order_item_id",), ("order_item_id", "order_id", "sale_price")),
    "stg_inventory_items": Contract(("inventory_item_id",), ("inventory_item_id",)),
    "stg_events": Contract(("event_id",), ("event_id", "created_at")),
    "dim_customers": Contract(
        ("user_id",), ("user_id",), accepted=(("customer_segment", CUSTOMER_SEGMENTS),)),
    "dim_products": Contract(("product_id",), ("product_id",)),
    "fct_orders": Contract(
        ("order_id",), ("order_id", "user_id"),
        accepted=(("status", ORDER_STATUSES),),
        references=(("user_id", "dim_customers", "user_id"),)),
    "fct_revenue_recognition": Contract(("order_date",), ("order_date", "recognized_revenue")),
    "fct_daily_kpis": Contract(("order_date",), ("order_date", "net_revenue", "net_orders")),
}


CONTRACT_KINDS = ("not_null", "unique", "accepted_values", "relationships")


@dataclass(frozen=True)
class Pass:
    """Checks that one frame answers, named by the table that the frame shows.

    ``beside`` lists raw columns that the frame holds beside the staged ones.
    """

    table: str
    checks: tuple[Labelled, ...]
    beside: tuple[str, ...] = ()


def passes(labelled: Sequence[Labelled]) -> list[Pass]:
    """Checks by frame. Raw and staged checks of a table share one: staging keeps every row.

    The raw key is judged where staging holds it, value for value; other raw columns are carried
    beside the staged ones.
    """
    frames: dict[str, list[Labelled]] = {}
    beside: dict[str, list[str]] = {}
    for item in labelled:
        table = item.table
        if table.startswith("raw."):
            spec = RAW_TABLES[table.removeprefix("raw.")]
            table = f"stg_{spec.name}"
            if item.check.column == spec.key:
                item = replace(item, held_in=spec.staged_key)
            else:
                item = replace(item, held_in=raw_alias(item.check.column))
                beside.setdefault(table, []).append(item.check.column)
        frames.setdefault(table, []).append(item)
    return [Pass(table, tuple(items), tuple(dict.fromkeys(beside.get(table, ()))))
            for table, items in frames.items()]


def run_pass(frame: Frames, one: Pass) -> DataFrame:
    """The report of one pass."""
    df = frame(one.table)
    if one.beside:
        name = one.table.removeprefix("stg_")
        df = beside_raw(name, frame(f"raw.{name}"), one.beside)
    return run_labelled(df, one.checks, one_pass=one.table in KEYED_TABLES)


def contract_checks(kinds: tuple[str, ...] = CONTRACT_KINDS) -> list[Labelled]:
    return [Labelled("contract", table, check)
            for table, contract in CONTRACTS.items() for check in contract.checks(kinds)]


def run_contracts(frame: Frames, kinds: tuple[str, ...] = CONTRACT_KINDS) -> DataFrame:
    """Report over the contract checks of every table.

    The kinds of one table share its passes, except references, which need the parent's keys.
    """
    reports = [run_pass(frame, one) for one in passes(contract_checks(kinds))]
    if "relationships" in kinds:
        reports += run_references(frame)
    return union_reports(reports)


def run_references(frame: Frames) -> list[DataFrame]:
    return [
        run_reference_check(frame(table), column, frame(parent), key, table, "contract")
        for table, contract in CONTRACTS.items()
        for column, parent, key in contract.references
    ]


def singular_checks() -> dict[str, list[Check]]:
    """The stand-alone assertions, by table."""
    return {
        "stg_order_items": [
            rule("non_negative_price", F.col("sale_price") >= 0, "sale_price")],
        "fct_revenue_recognition": [
            rule("revenue_reconciles", finance_reconciles(), "recon_check")],
    }


def all_reports(frame: Frames, bands: Bands = Bands()) -> list[DataFrame]:
    """Contracts, assertions and value suites as one report per frame and per reference.

    The suites share the passes over a table. The reports are small, independent jobs.
    """
    labelled = contract_checks()
    for suite, tables in (("singular", singular_checks()), ("values", value_suites(bands))):
        labelled += [Labelled(suite, table, c) for table, checks in tables.items() for c in checks]
    return [run_pass(frame, one) for one in passes(labelled)] + run_references(frame)


def negative_prices(items: DataFrame) -> DataFrame:
    """Offending lines."""
    return items.filter(F.col("sale_price") < 0).select("order_item_id", "sale_price")


# Row rules of the daily and finance marts: what must hold.
DAY_RULES: dict[str, tuple[str, Callable[[], Column]]] = {
    "ladder_order": ("fct_daily_kpis", ladder_ordered),
    "recognized_le_net": ("fct_daily_kpis", recognized_within_net),
    "active_le_orders": ("fct_daily_kpis", active_within_orders),
    "finance_recon": ("fct_revenue_recognition", finance_reconciles),
}


def offending_days(frame: Frames, names: Sequence[str] = tuple(DAY_RULES)) -> DataFrame:
    """(rule, order_date) of every day that breaks a rule of its mart; NULL breaks nothing.

    The rules of one mart are judged in one pass.
    """
    found = []
    for table in dict.fromkeys(DAY_RULES[n][0] for n in names):
        broken = F.array(*[F.when(~DAY_RULES[n][1](), F.lit(n))
                           for n in names if DAY_RULES[n][0] == table])
        found.append(frame(table).select("order_date", F.explode(broken).alias("rule"))
                     .filter("rule IS NOT NULL"))
    return union_reports(found).select("rule", "order_date")


def unreconciled_days(recognition: DataFrame) -> DataFrame:
    """Offending days with both sides and their difference."""
    return recognition.filter(~finance_reconciles()).select(
        "order_date", "net_revenue_mgmt", "recon_check",
        F.abs(F.col("net_revenue_mgmt") - F.col("recon_check")).alias("diff"),
    )
