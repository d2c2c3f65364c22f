"""Check types and the runner that evaluates the checks of a table together.

Every check yields one row of :data:`REPORT_SCHEMA`. NULL handling follows the usual contract
rules: only ``not_null`` objects to a NULL; a rule violated only when it is definitely false.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "suite string, table_name string, check_name string, column_name string, "
    "success boolean, evaluated bigint, violations bigint"
)
NOT_NULL = "not_null"
# Marts that their plan already leaves grouped or joined by their key.
KEYED_TABLES = ("fct_daily_kpis", "fct_revenue_recognition", "dim_customers")


@dataclass(frozen=True)
class RowCheck:
    """A check decided row by row.

    ``violated`` marks offending values of the column (NULL counts as no offence). ``mostly`` is
    the share of evaluated rows that must be fine. ``nulls_count`` tells whether NULL values are
    evaluated.
    """

    name: str
    column: str
    violated: Callable[[Column], Column]
    mostly: float = 1.0
    nulls_count: bool = False


@dataclass(frozen=True)
class UniqueCheck:
    """No value of ``column`` occurs twice; NULLs are ignored.

    ``per_value`` counts duplicated values, otherwise every row of a duplicated value counts.
    """

    column: str
    per_value: bool = False
    name: str = "unique"


def not_null(column: str) -> RowCheck:
    return RowCheck(NOT_NULL, column, lambda value: value.isNull(), nulls_count=True)


def accepted_values(column: str, values: Sequence[str]) -> RowCheck:
    return RowCheck("accepted_values", column, lambda value: ~value.isin(*values))


def between(
    column: str, low: float | None = None, high: float | None = None, mostly: float = 1.0
) -> RowCheck:
    """Inclusive range with either bound optional."""

    def outside(value: Column) -> Column:
        below = F.lit(False) if low is None else value < low
        above = F.lit(False) if high is None else value > high
        return below | above

    name = "between" if mostly == 1.0 else "between_mostly"
    return RowCheck(name, column, outside, mostly=mostly)


def rule(name: str, holds: Column, column: str) -> RowCheck:
    """An invariant across columns of one row, reported under ``column``."""
    return RowCheck(f"rule:{name}", column, lambda _: ~holds, nulls_count=True)


Check = RowCheck | UniqueCheck


@dataclass(frozen=True)
class Labelled:
    """A check with the suite and table it is reported under.

    ``held_in`` names the column of the frame that holds the checked values, if the frame calls it
    otherwise than the check does. Checks of several tables can so share the passes over one frame.
    """

    suite: str
    table: str
    check: Check
    held_in: str = ""

    @property
    def column(self) -> str:
        return self.held_in or self.check.column


def run_checks(df: DataFrame, table: str, checks: Sequence[Check], suite: str) -> DataFrame:
    """Report rows for one suite's checks of a table, computed lazily."""
    labelled = [Labelled(suite, table, check) for check in checks]
    return run_labelled(df, labelled, one_pass=table in KEYED_TABLES)


def run_labelled(df: DataFrame, checks: Sequence[Labelled], one_pass: bool = False) -> DataFrame:
    """Report rows for checks of several suites on one frame.

    All row checks add up in a single aggregation without a shuffle. Each unique column costs one
    grouping of that column alone, which also answers whether it is ever NULL. With ``one_pass``
    the row checks ride along in the first grouping instead: worth it where the table leaves its
    plan already partitioned by that column, so that the grouping needs no shuffle and a second
    pass would repeat the work upstream.
    """
    uniques = [c for c in checks if isinstance(c.check, UniqueCheck)]
    keys = list(dict.fromkeys(c.column for c in uniques))
    on_key = {key: [c for c in uniques if c.column == key] for key in keys}
    rows = []
    for labelled in checks:
        if isinstance(labelled.check, RowCheck):
            is_key_null = labelled.check.name == NOT_NULL and labelled.column in on_key
            (on_key[labelled.column] if is_key_null else rows).append(labelled)

    reports = []
    if rows and not (one_pass and keys):
        reports.append(_row_report(df, rows))
        rows = []
    for key in keys:
        reports.append(_key_report(df, key, on_key[key], rows))
        rows = []
    return union_reports(reports)


class _Counters:
    """Aggregates that count evaluated values and violations of row checks.

    Checks that ask the same of the same column share their counter.
    """

    def __init__(self, rows: Sequence[Labelled]):
        self._rows = rows
        valued = sorted({c.column for c in rows if not c.check.nulls_count})
        self._seen = {column: f"n_{i}" for i, column in enumerate(valued)}
        self._nulls = {column: f"z_{i}" for i, column in enumerate(dict.fromkeys(
            c.column for c in rows if c.check.name == NOT_NULL))}

    def aggregates(self) -> list[Column]:
        return [
            F.count("*").alias("n_rows"),
            *[F.count(column).alias(alias) for column, alias in self._seen.items()],
            *[F.count_if(F.col(column).isNull()).alias(alias)
              for column, alias in self._nulls.items()],
            *[F.count_if(c.check.violated(F.col(c.column))).alias(f"v_{i}")
              for i, c in enumerate(self._rows) if c.check.name != NOT_NULL],
        ]

    def names(self) -> list[str]:
        return ["n_rows", *self._seen.values(), *self._nulls.values(),
                *[f"v_{i}" for i, c in enumerate(self._rows) if c.check.name != NOT_NULL]]

    def results(self) -> list[str]:
        results = []
        for i, labelled in enumerate(self._rows):
            check = labelled.check
            evaluated = "n_rows" if check.nulls_count else self._seen[labelled.column]
            violations = self._nulls[labelled.column] if check.name == NOT_NULL else f"v_{i}"
            ok = f"{violations} = 0"
            if check.mostly < 1.0:
                # NULL without a single value to judge, which is no failure.
                share = f"try_divide({evaluated} - {violations}, {evaluated})"
                ok = f"coalesce({share} >= {check.mostly}, true)"
            results.append(_result(labelled, ok, evaluated, violations))
        return results


def _row_report(df: DataFrame, rows: Sequence[Labelled]) -> DataFrame:
    counters = _Counters(rows)
    return df.agg(*counters.aggregates()).select(_report_rows(counters.results()))


def write_checked(df: DataFrame, path: str, table: str, checks: Sequence[Check],
                  suite: str) -> DataFrame:
    """Write ``df`` and judge it by the same job; returns the report.

    Row checks are counted on the rows as they are written. A task that ran twice may have been
    counted twice; its rows then make the counted rows differ from those that the footers of the
    written files tell, and the checks are run on the written table instead. Unique columns need a
    grouping, which reads them back.
    """
    spark = df.sparkSession
    rows = [Labelled(suite, table, c) for c in checks if isinstance(c, RowCheck)]
    counters = _Counters(rows)
    observed = Observation()
    df.observe(observed, *counters.aggregates()).write.mode("error").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    counted = observed.get
    if counted["n_rows"] != written.count():
        return run_checks(written, table, checks, suite)
    names = counters.names()
    line = spark.createDataFrame([tuple(counted[n] for n in names)],
                                 ", ".join(f"{n} bigint" for n in names))
    uniques = [c for c in checks if isinstance(c, UniqueCheck)]
    reports = [line.select(_report_rows(counters.results()))] if rows else []
    reports += [run_checks(written, table, uniques, suite)] if uniques else []
    return union_reports(reports)


def _key_report(
    df: DataFrame, key: str, on_key: Sequence[Labelled], riders: Sequence[Labelled]
) -> DataFrame:
    counters = _Counters(riders)
    value, n_rows = F.col("_value"), F.col("n_rows")
    repeated = value.isNotNull() & (n_rows > 1)

    def total(rows: Column, alias: str) -> Column:
        return F.coalesce(F.sum(rows), F.lit(0)).alias(alias)

    summary = (
        df.withColumn("_value", F.col(key)).groupBy("_value").agg(*counters.aggregates())
        .agg(
            *[total(F.col(name), name) for name in counters.names()],
            total(F.when(value.isNull(), n_rows), "null_rows"),
            total(F.when(repeated, n_rows), "repeated_rows"),
            F.count_if(repeated).alias("repeated_values"),
        )
    )
    results = counters.results()
    for labelled in on_key:
        if isinstance(labelled.check, RowCheck):
            evaluated, violations = "n_rows", "null_rows"
        else:
            evaluated = "n_rows - null_rows"
            violations = "repeated_values" if labelled.check.per_value else "repeated_rows"
        results.append(_result(labelled, f"{violations} = 0", evaluated, violations))
    return summary.select(_report_rows(results))


def _result(labelled: Labelled, success: str, evaluated: str, violations: str) -> str:
    """One report row as a SQL expression over the counters."""
    labels = {"suite": labelled.suite, "table_name": labelled.table,
              "check_name": labelled.check.name, "column_name": labelled.check.column}
    texts = ", ".join(f"'{name}', '{value}'" for name, value in labels.items())
    return (
        f"named_struct({texts}, 'success', {success}, "
        f"'evaluated', cast({evaluated} AS bigint), 'violations', cast({violations} AS bigint))"
    )


def _report_rows(results: Sequence[str]) -> Column:
    return F.expr(f"inline(array({', '.join(results)}))")


def run_reference_check(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, table: str, suite: str
) -> DataFrame:
    """Rows whose non-NULL reference has no parent.

    The child is reduced to one counted row per referenced value before it meets the parent, so a
    value held by a third of all rows is a single row in the join.
    """
    held = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    orphans = held.join(known.withColumn("known", F.lit(1)), "value", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated"),
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("bad"),
    )
    check = RowCheck("relationships", column, lambda value: F.lit(False))
    labelled = Labelled(suite, table, check)
    return orphans.select(_report_rows([_result(labelled, "bad = 0", "evaluated", "bad")]))


def union_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def gate_summary(report: DataFrame) -> DataFrame:
    """Totals of a report and whether the gate opens."""
    return report.agg(
        F.count("*").alias("checks"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
    ).withColumn("gate_open", F.col("failed") == 0)
