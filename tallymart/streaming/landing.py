"""Incremental landing: new files of a drop folder become committed batches of a raw table.

A streaming file source finds the files that arrived since the last run and hands them over in
micro-batches; its checkpoint lies beside the landed table. Each micro-batch is written to a folder
of its own and committed by an entry that is created only if the batch has none yet. A batch that is
run again, because the run before ended between writing and committing or between committing and the
checkpoint, therefore lands once; what the ended run left behind is named by no entry.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.timestamps import naive_literal
from tallymart.sources.commits import CommitLog, put_if_absent
from tallymart.specs import RAW_TABLES

BATCH_SCHEMA = "batch bigint, rows bigint, loaded_at timestamp_ntz"
AUDIT = "_loaded_at timestamp_ntz, _source_file string"


def _folder(raw_dir: str, table: str) -> str:
    return f"{raw_dir.rstrip('/')}/incremental/{table}"


def land_new_files(
    spark: SparkSession, drop_dir: str, raw_dir: str, table: str, loaded_at: dt.datetime,
    files_per_batch: int | None = None,
) -> int:
    """Land the CSV files below ``drop_dir`` that no earlier run has landed; returns their rows.

    Files have a header and the declared columns in the declared order; a value that does not fit
    its type fails the run, and the next run starts with the same files. A file must not change once
    it is there.
    """
    folder = _folder(raw_dir, table)
    landed_before = sum(_batch_rows(spark, folder))
    stamp = loaded_at.replace(microsecond=0)
    source = (
        spark.readStream.schema(T.StructType.fromDDL(RAW_TABLES[table].schema))
        .option("header", True).option("escape", '"').option("mode", "FAILFAST")
        .option("timeZone", "UTC").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv"))
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = source.csv(drop_dir).select(
        "*", naive_literal(stamp).alias("_loaded_at"),
        F.col("_metadata.file_path").alias("_source_file"))
    query = (
        rows.writeStream.foreachBatch(batch_writer(spark, folder, stamp))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(_batch_rows(spark, folder)) - landed_before


def batch_writer(spark: SparkSession, folder: str,
                 stamp: dt.datetime) -> Callable[[DataFrame, int], None]:
    """Writes and commits one micro-batch, unless it is committed already."""

    def write(batch: DataFrame, number: int) -> None:
        log = CommitLog(spark, f"{folder}/batches")
        # Versions start at 1, numbers of micro-batches at 0.
        if number + 1 in log.versions():
            return
        attempt = f"{folder}/data/{number:020d}-{uuid.uuid4().hex}"
        batch.write.mode("error").parquet(attempt)
        # From the footers: a repeated task is not counted twice.
        entry = {"version": number + 1, "folder": attempt, "loaded_at": stamp.isoformat(),
                 "rows": spark.read.parquet(attempt).count()}
        put_if_absent(spark, f"{folder}/batches/{number + 1:020d}.json", json.dumps(entry))

    return write


def _batches(spark: SparkSession, folder: str) -> list[dict]:
    log = CommitLog(spark, f"{folder}/batches")
    return [log.read(v) for v in log.versions()]


def _batch_rows(spark: SparkSession, folder: str) -> list[int]:
    return [entry["rows"] for entry in _batches(spark, folder)]


def read_landed(spark: SparkSession, raw_dir: str, table: str,
                since: int = 0) -> DataFrame:
    """The committed rows of a table, from batch ``since`` on."""
    folders = [e["folder"] for e in _batches(spark, _folder(raw_dir, table))
               if e["version"] > since]
    schema = T.StructType.fromDDL(f"{RAW_TABLES[table].schema}, {AUDIT}")
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def landed_batches(spark: SparkSession, raw_dir: str, table: str) -> DataFrame:
    """One row per committed batch."""
    return spark.createDataFrame(
        [(e["version"] - 1, e["rows"], dt.datetime.fromisoformat(e["loaded_at"]))
         for e in _batches(spark, _folder(raw_dir, table))], BATCH_SCHEMA)
