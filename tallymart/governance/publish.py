"""Write, audit, publish: marts go live together, and only if every check passes.

Every attempt of a run writes its marts to folders that no other attempt uses. Going live is one
numbered entry in the publication log, which names the attempt; readers follow the newest entry. A
failed attempt adds none, whatever its run id, so the last good version stays live, and no reader
ever sees a half-written mart. Publishers may run at the same time: each gets a version of its own.
Folders that no entry names can be deleted.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.plans.layers import MARTS, Layers
from tallymart.quality.checks import REPORT_SCHEMA, gate_summary
from tallymart.quality.suites import Bands, all_reports
from tallymart.sources.commits import CommitLog
from tallymart.sources.exchange import write_json
from tallymart.sources.landing import append_load_report, load_raw, read_raw
from tallymart.workspace import side_by_side


class GateClosed(Exception):
    """Checks failed; ``failures`` lists them and nothing was published.

    ``folder`` holds the marts and the report of the rejected attempt.
    """

    def __init__(self, run_id: str, folder: str, failures: list[str]):
        super().__init__(f"run {run_id} is not published: {'; '.join(failures)}")
        self.folder = folder
        self.failures = failures


def mart_path(root: str, folder: str, mart: str) -> str:
    return f"{root.rstrip('/')}/marts/{mart}/attempt={folder}"


def publications(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/published")


def write_marts(layers: Layers, root: str, folder: str) -> dict[str, DataFrame]:
    """Write the marts of an attempt and read them back.

    The order fact is written first and the daily, finance and customer marts are built from the
    written table, so the line table is rolled up once.
    """
    spark = layers.fct_orders.sparkSession
    layers.fct_orders.write.mode("error").parquet(mart_path(root, folder, "fct_orders"))
    orders = spark.read.parquet(mart_path(root, folder, "fct_orders"))
    built = Layers(layers.raw, written_orders=orders)
    side_by_side(partial(built.mart(m).write.mode("error").parquet, mart_path(root, folder, m))
                 for m in MARTS if m != "fct_orders")
    return read_run(spark, root, folder)


def read_run(spark: SparkSession, root: str, folder: str) -> dict[str, DataFrame]:
    return {m: spark.read.parquet(mart_path(root, folder, m)) for m in MARTS}


def audit(layers: Layers, marts: dict[str, DataFrame], bands: Bands = Bands()) -> DataFrame:
    """Every contract, assertion and value check over the raw, staged and written tables.

    One job per table, a few at a time: a single plan over all tables would be replanned as a
    whole after each of its many stages. What reaches the driver is one row per declared check.
    """
    reports = all_reports(resolver(layers, marts), bands)
    rows = [row for found in side_by_side(r.collect for r in reports) for row in found]
    return layers.fct_orders.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def resolver(
    layers: Layers, marts: dict[str, DataFrame] | None = None
) -> Callable[[str], DataFrame]:
    """Look up a table by its qualified name: ``raw.<t>``, ``stg_<t>`` or a mart."""
    def frame(name: str) -> DataFrame:
        if name.startswith("raw."):
            return layers.raw[name.removeprefix("raw.")]
        if name.startswith("stg_"):
            return layers.staged(name.removeprefix("stg_"))
        return marts[name] if marts and name in marts else layers.mart(name)

    return frame


def publish(
    layers: Layers, root: str, run_id: str, now: dt.datetime, bands: Bands = Bands()
) -> DataFrame:
    """Write the marts, check them, and make them live; returns the quality report.

    Raises :class:`GateClosed` if any check fails. Of publishers that run at the same time the one
    that is checked last goes live last; all of their versions stay in the log.
    """
    folder = f"{run_id}-{uuid.uuid4().hex}"
    marts = write_marts(layers, root, folder)
    report = audit(layers, marts, bands)
    write_json(report, f"{root.rstrip('/')}/reports/{folder}")
    if not gate_summary(report).first()["gate_open"]:
        failed = report.filter(~F.col("success")).collect()
        raise GateClosed(run_id, folder, [
            f"{r.table_name}.{r.column_name} {r.check_name}" for r in failed])
    publications(report.sparkSession, root).commit(
        lambda _: {"run_id": run_id, "folder": folder, "published_at": now.isoformat()})
    return report


def live_run(spark: SparkSession, root: str) -> str | None:
    """The run readers should use, or None before the first publication."""
    newest = publications(spark, root).newest()
    return newest["run_id"] if newest else None


def live_folder(spark: SparkSession, root: str) -> str:
    """The folder of the live marts."""
    newest = publications(spark, root).newest()
    if newest is None:
        raise LookupError(f"nothing is published under {root}")
    return newest["folder"]


def live_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published marts."""
    return read_run(spark, root, live_folder(spark, root))


def attach_marts(spark: SparkSession, root: str, database: str = "main_marts") -> list[str]:
    """Views ``<database>.<mart>`` over the live marts, for SQL consumers.

    A view looks up the newest publication whenever it is queried: all of them switch together, also
    within one statement, and none has to be made anew. They read files and give nobody a way to
    write them.
    """
    live_folder(spark, root)  # something has to be published
    log = f"text.`{root.rstrip('/')}/published`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for mart in MARTS:
        spark.sql(f"""
            CREATE OR REPLACE VIEW {database}.{mart} AS
            SELECT * EXCEPT (attempt) FROM parquet.`{root.rstrip('/')}/marts/{mart}`
            WHERE attempt = (
                SELECT max_by(get_json_object(value, '$.folder'),
                              CAST(get_json_object(value, '$.version') AS BIGINT)) FROM {log})""")
    return [f"{database}.{mart}" for mart in MARTS]


def refresh(
    spark: SparkSession,
    source_dir: str,
    root: str,
    now: dt.datetime,
    run_id: str | None = None,
    bands: Bands = Bands(),
) -> DataFrame:
    """The daily run: land all tables, build the marts, check and publish them."""
    run_id = run_id or now.strftime("%Y%m%dT%H%M%S")
    raw_dir = f"{root.rstrip('/')}/raw"
    load_report = load_raw(spark, source_dir, raw_dir, now, strict=True)
    append_load_report(load_report, run_id, f"{root.rstrip('/')}/load_log")
    return publish(Layers(read_raw(spark, raw_dir)), root, run_id, now, bands)
