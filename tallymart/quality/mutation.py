"""Defect injection: corrupt one row of a copy and see which checks turn red.

A defect is an extra column that equals the original everywhere but in one row. The checks run on
both columns in the same pass, so before and after cost one reading of the table, and the table
itself is never changed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.quality.checks import (
    RowCheck,
    UniqueCheck,
    run_checks,
    union_reports,
)
from tallymart.quality.suites import Bands, value_suites
from tallymart.workspace import side_by_side


@dataclass(frozen=True)
class Defect:
    """``bad`` replaces ``column`` in the row with the smallest ``key``.

    Without ``bad`` the row with the second smallest key takes over the smallest one, as a
    fanned-out join would produce it.
    """

    name: str
    table: str
    key: str
    column: str
    bad: Column | None = None


def standard_defects() -> list[Defect]:
    return [
        Defect("negative_price", "stg_order_items", "order_item_id", "sale_price", F.lit(-42.0)),
        Defect("null_date", "fct_daily_kpis", "order_date", "order_date",
               F.lit(None).cast("date")),
        Defect("rate_above_one", "fct_daily_kpis", "order_date", "refund_rate", F.lit(1.5)),
        Defect("duplicate_key", "dim_customers", "user_id", "user_id"),
    ]


Keys = tuple[object, object]


def smallest_keys(df: DataFrame, key: str) -> Keys:
    """The two smallest values of a key column; NULL where there are fewer.

    Two passes over the one column, of which each task returns one value: no keys are shuffled.
    """
    smallest = df.agg(F.min(key)).first()[0]
    if smallest is None:
        return None, None
    above = F.col(key) > F.lit(smallest).cast(df.schema[key].dataType)
    return smallest, df.agg(F.min(F.when(above, F.col(key)))).first()[0]


def corrupted(df: DataFrame, defect: Defect, keys: Keys | None = None) -> Column:
    """The defective version of the column; ``keys`` are the two smallest, if known."""
    smallest, second = keys or smallest_keys(df, defect.key)
    kind = df.schema[defect.key].dataType
    key, first = F.col(defect.key), F.lit(smallest).cast(kind)
    if defect.bad is not None:
        return F.when(key == first, defect.bad).otherwise(F.col(defect.column))
    return F.when(key == F.lit(second).cast(kind), first).otherwise(key)


def inject(df: DataFrame, defect: Defect) -> DataFrame:
    """A copy of ``df`` with the defect in place."""
    return df.withColumn(defect.column, corrupted(df, defect))


def detect_defects(
    frame: Callable[[str], DataFrame],
    defects: list[Defect] | None = None,
    bands: Bands = Bands(),
) -> DataFrame:
    """For every defect, the checks on its column before and after it was injected.

    Checks on other columns see the same values twice and cannot turn red. Every table is read once
    for the two smallest keys, which all its defects share, and once for all checks; tables whose
    plan is long are better passed written.
    """
    defects = standard_defects() if defects is None else defects
    reports = []
    wanted = list(dict.fromkeys((d.table, d.key) for d in defects))
    found = dict(zip(wanted, side_by_side(
        partial(smallest_keys, frame(table), key) for table, key in wanted)))
    for table in dict.fromkeys(d.table for d in defects):
        original, suite = frame(table), value_suites(bands)[table]
        spoiled = original
        checks: dict[RowCheck | UniqueCheck, None] = {}
        # Checked column -> the (defect, after injection?, column) roles it plays.
        roles: dict[str, list[tuple[str, bool, str]]] = {}
        for defect in (d for d in defects if d.table == table):
            bad_column = f"{defect.column}__{defect.name}"
            spoiled = spoiled.withColumn(
                bad_column, corrupted(original, defect, found[table, defect.key]))
            for check in suite:
                if check.column == defect.column and not check.name.startswith("rule:"):
                    checks |= {check: None, replace(check, column=bad_column): None}
            roles.setdefault(defect.column, []).append((defect.name, False, defect.column))
            roles[bad_column] = [(defect.name, True, defect.column)]
        by_column = F.create_map(*[
            part for column, played in roles.items()
            for part in (F.lit(column), F.array(*[_role(*r) for r in played]))
        ])
        reports.append(
            run_checks(spoiled, table, list(checks), "mutation")
            .withColumn("roles", by_column[F.col("column_name")])
            .select("table_name", "check_name", "success", "violations", F.inline("roles"))
        )
    after = F.col("is_after")
    return (
        union_reports(reports)
        .groupBy("defect", "table_name", "check_name", "column_name")
        .agg(
            F.max(F.when(~after, F.col("success"))).alias("passed_before"),
            F.max(F.when(after, F.col("success"))).alias("passed_after"),
            F.max(F.when(after, F.col("violations"))).alias("violations_after"),
        )
        .withColumn("caught", F.col("passed_before") & ~F.col("passed_after"))
    )


def _role(defect: str, is_after: bool, column: str) -> Column:
    return F.struct(
        F.lit(defect).alias("defect"),
        F.lit(is_after).alias("is_after"),
        F.lit(column).alias("column_name"),
    )
