"""Landing of CSV drops as raw Parquet tables with audit columns.

A load writes its tables to a batch folder of its own. When all of them are in, one numbered entry
says which batch each table is read from; readers follow the newest entry, or an earlier one. A load
that fails adds none, so the tables before it stay readable and consistent with each other. Loads
may run at the same time: each adds its tables to whatever is newest when it ends.

:func:`forget_before` ends the life of old versions and deletes the folders that only they name.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.timestamps import naive_literal
from tallymart.sources.commits import CommitLog, remove
from tallymart.specs import RAW_TABLES
from tallymart.workspace import compact, side_by_side

VERSIONS_SCHEMA = "version bigint, loaded_at timestamp_ntz, tables array<string>"
LOAD_REPORT_SCHEMA = "table_name string, rows bigint, status string, loaded_at timestamp_ntz"


class MissingSource(Exception):
    """A source folder or, in strict mode, an expected table file is missing."""


class VersionGone(LookupError):
    """A version that was never there or is not kept any more."""


class MissingColumn(Exception):
    """A declared column is not in the header of the file."""


def read_csv(spark: SparkSession, path: str, schema: str, multiline: bool = False) -> DataFrame:
    """A CSV file (or folder of part files) with a header, read with declared types.

    Columns are matched by name; columns beyond the declared ones are landed as text. Types are
    declared, not sniffed: a postal code keeps its leading zero, and a value that does not fit
    fails the load, as does a part file with another header. Timestamps without an offset in an
    instant column are UTC. With ``multiline`` quoted fields may hold line breaks; one task then
    reads each file from end to end.
    """
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("multiLine", multiline))
    declared = {field.name: field for field in T.StructType.fromDDL(schema)}
    header = reader.csv(path).columns
    if missing := declared.keys() - set(header):
        raise MissingColumn(f"{path} lacks {', '.join(sorted(missing))}")
    fields = [declared.get(name, T.StructField(name, T.StringType())) for name in header]
    return (
        reader.schema(T.StructType(fields))
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("timeZone", "UTC")
        .csv(path)
    )


def with_audit(raw: DataFrame, loaded_at: dt.datetime, source_file: str) -> DataFrame:
    """Add when the batch was landed (naive UTC, whole seconds), the drop file each row comes from,
    and the part of it where the drop is a folder."""
    return raw.select(
        "*",
        naive_literal(loaded_at.replace(microsecond=0)).alias("_loaded_at"),
        F.lit(source_file).alias("_source_file"),
        F.col("_metadata.file_name").alias("_source_part"),
    )


def load_table(
    spark: SparkSession, csv_path: str, table: str, target: str, loaded_at: dt.datetime
) -> int:
    """Land one CSV in ``target``; returns the number of rows landed.

    The count is taken from the footers of the landed files, so a task that was repeated after an
    executor loss is not counted twice.
    """
    spec = RAW_TABLES[table]
    raw = read_csv(spark, csv_path, spec.schema, spec.multiline)
    source_file = csv_path.rstrip("/").rsplit("/", 1)[-1]
    landed = with_audit(raw, loaded_at, source_file)
    landed.write.mode("error").options(**compact(landed)).parquet(target)
    return spark.read.parquet(target).count()


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def load_raw(
    spark: SparkSession,
    source_dir: str,
    raw_dir: str,
    loaded_at: dt.datetime,
    strict: bool = False,
) -> DataFrame:
    """Land every expected ``<table>.csv``; returns the load report.

    Missing files are reported as skipped, or abort the load before anything is written in strict
    mode; a skipped table stays as it was. All tables of the load are replaced together, after the
    last one is in. Landing the same files again gives the same tables.
    """
    if not _exists(spark, source_dir):
        raise MissingSource(f"source folder not found: {source_dir}")
    paths = {name: f"{source_dir.rstrip('/')}/{name}.csv" for name in RAW_TABLES}
    missing = [name for name, path in paths.items() if not _exists(spark, path)]
    if strict and missing:
        raise MissingSource(f"expected tables without a file: {', '.join(missing)}")
    stamp = loaded_at.replace(microsecond=0)
    present = [name for name in paths if name not in missing]
    batch = uuid.uuid4().hex
    landed = dict(zip(present, side_by_side(
        partial(load_table, spark, paths[name], name, batch_path(raw_dir, batch, name), stamp)
        for name in present
    )))
    versions_of(spark, raw_dir).commit(lambda newest: {
        "tables": {**(newest["tables"] if newest else {}), **dict.fromkeys(present, batch)},
        "loaded_at": stamp.isoformat(), "oldest": newest["oldest"] if newest else 1})
    report = [
        (name, landed[name], "loaded", stamp) if name in landed else (name, None, "skipped", None)
        for name in paths
    ]
    return spark.createDataFrame(report, LOAD_REPORT_SCHEMA)


def batch_path(raw_dir: str, batch: str, table: str) -> str:
    return f"{raw_dir.rstrip('/')}/batches/{batch}/{table}"


def versions_of(spark: SparkSession, raw_dir: str) -> CommitLog:
    return CommitLog(spark, f"{raw_dir.rstrip('/')}/versions")


def read_raw(spark: SparkSession, raw_dir: str, version: int | None = None) -> dict[str, DataFrame]:
    """The landed raw tables that exist, as of a version or the newest one."""
    log = versions_of(spark, raw_dir)
    entry = log.newest()
    if version is not None:
        if entry is None or not entry["oldest"] <= version <= entry["version"]:
            raise VersionGone(f"version {version} of {raw_dir}")
        entry = log.read(version)
    batches = entry["tables"] if entry else {}
    return {name: spark.read.parquet(batch_path(raw_dir, batches[name], name))
            for name in RAW_TABLES if name in batches}


def raw_versions(spark: SparkSession, raw_dir: str) -> DataFrame:
    """The versions that can be read, one row each, with the tables that they replaced."""
    log, before, rows = versions_of(spark, raw_dir), {}, []
    oldest = (log.newest() or {"oldest": 1})["oldest"]
    for version in log.versions():
        entry = log.read(version)
        changed = sorted(t for t, b in entry["tables"].items() if before.get(t) != b)
        before = entry["tables"]
        if version >= oldest:
            rows.append((version, dt.datetime.fromisoformat(entry["loaded_at"]), changed))
    return spark.createDataFrame(rows, VERSIONS_SCHEMA)


def forget_before(spark: SparkSession, raw_dir: str, version: int) -> list[str]:
    """Give up the versions before ``version`` and delete what only they name.

    First an entry says that they are gone, then folders are deleted; a call that was interrupted is
    made good by the next one. Folders of loads that have yet to end are named by no entry and stay.
    Returns the deleted folders.
    """
    log = versions_of(spark, raw_dir)

    def shortened(newest: dict | None) -> dict:
        if newest is None or not newest["oldest"] <= version <= newest["version"]:
            raise VersionGone(f"version {version} of {raw_dir}")
        return {**newest, "oldest": version}

    last = log.commit(shortened)["version"]
    named: dict[bool, set[tuple[str, str]]] = {False: set(), True: set()}
    for number in log.versions():
        # Whatever later entries name is new or in the last one.
        named[version <= number <= last].update(
            (batch, table) for table, batch in log.read(number)["tables"].items())
    gone = [batch_path(raw_dir, batch, table) for batch, table in
            sorted(named[False] - named[True]) if _exists(spark, batch_path(raw_dir, batch, table))]
    for folder in gone:
        remove(spark, folder)
    return gone


def append_load_report(report: DataFrame, run_id: str, log_dir: str) -> None:
    """Keep the report of one load of a run in the health log."""
    reported_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    report.withColumns({
        "run_id": F.lit(run_id), "reported_at": naive_literal(reported_at),
    }).coalesce(1).write.mode("append").parquet(log_dir)


def load_health(log: DataFrame) -> DataFrame:
    """Rows and tables per run, with the change against the run before.

    Of a run that was repeated, the last report of each table counts.
    """
    latest = log.groupBy("run_id", "table_name").agg(
        F.max_by(F.struct("rows", "status", "loaded_at"), "reported_at").alias("last")
    ).select("run_id", "last.*")
    runs = latest.groupBy("run_id").agg(
        F.max("loaded_at").alias("loaded_at"),
        F.sum("rows").alias("rows"),
        F.count_if(F.col("status") == "loaded").alias("tables_loaded"),
        F.count_if(F.col("status") == "skipped").alias("tables_skipped"),
    )
    # One row per run: the window holds the run history, not data.
    in_order = Window.orderBy("loaded_at", "run_id")
    return runs.withColumn("rows_change", F.col("rows") - F.lag("rows").over(in_order))
