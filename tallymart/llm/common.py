"""Reading the corpus tables, and text helpers that several operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Clusters that install or ship the package need nothing; this serves sessions whose workers start
    in another folder than the driver.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


BATCH_ROWS = 500  # rows of text that go to a Python worker at a time


def bound_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch to ``BATCH_ROWS`` in this session.

    Spark's own bound of 10,000 rows suits numbers; of long texts it makes batches that a worker
    cannot hold several times over.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def utf8_bytes(text: Column) -> Column:
    """Bytes of the UTF-8 form; 0 for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def utf8_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 form; NULL counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
