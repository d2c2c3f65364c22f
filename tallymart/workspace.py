"""Shared scratch storage for results that several later steps read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Writer options of Parquet files that this package reads again: keys and times are kept as
# differences and text by its prefixes, where a column has too many values for a dictionary. Pages
# of up to 4 MB give the codec more to find repeats in.
COMPACT = {
    "compression": "zstd", "parquet.compression.codec.zstd.level": "6",
    "parquet.writer.version": "v2",
    "parquet.page.size": str(4 << 20), "parquet.page.row.count.limit": "1000000",
}


def compact(df: DataFrame) -> dict[str, str]:
    """Writer options for the columns of ``df``: its 64-bit keys and counts get no dictionary, which
    would hold most of their values, but are kept as differences."""
    return COMPACT | {
        f"parquet.enable.dictionary#{name}": "false" for name, kind in df.dtypes if kind == "bigint"}


def side_by_side(jobs: Iterable[Callable[[], T]], width: int = 8) -> list[T]:
    """Results of independent jobs, a few submitted at a time.

    The small tables then fill the cores that the last tasks of a large table leave idle. An
    error in any job is raised.
    """
    with ThreadPoolExecutor(max_workers=width) as pool:
        return list(pool.map(lambda job: job(), jobs))


def release_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished jobs.

    It does so once the driver's garbage collector finds that no plan needs them any more, which
    may take half an hour while the driver has memory to spare.
    """
    spark.sparkContext._jvm.System.gc()


def one_machine(master: str) -> bool:
    """Whether driver and tasks share one process; ``local-cluster`` has executors of its own."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one piece of intermediate output; every call names another one.

    Results are lazy: a folder shared by two calls would let the second overwrite what the first
    has yet to read. The cluster names a shared folder in ``spark.checkpoint.dir``. Without that
    setting a temporary folder is used in local mode; on a cluster its absence is an error,
    because a machine-local folder is not visible to other executors.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/tallymart/{spark.conf.get('spark.app.id')}"
        return f"{folder}/{uuid.uuid4().hex}/{name}"
    if not one_machine(spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{tempfile.mkdtemp(prefix='tallymart-')}/{name}"


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return the written table.

    Cuts the lineage in a way that survives executor loss, and lets several consumers share one
    computation.
    """
    df.write.mode("overwrite").options(**compact(df)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
