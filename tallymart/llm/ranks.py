"""Gapless positions of sorted rows, without one task that sees all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.workspace import scratch_dir, write_and_read

_LOW_BITS = 33  # monotonically_increasing_id: the partition above, the row in it below


def with_positions(rows: DataFrame, order: list[str | Column], partitions: int, name: str,
                   position: str = "position") -> tuple[DataFrame, int]:
    """``rows`` with a gapless long ``position`` in the given order, and the number of rows.

    The rows are range-partitioned, sorted and written to the scratch folder together with their
    place in their partition; what is read back no longer changes when a task is repeated. Only
    one count per partition reaches the driver. Rows that are equal in every sort key get
    positions in either order.
    """
    spark = rows.sparkSession
    placed = (
        rows.repartitionByRange(max(1, partitions), *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    written = write_and_read(placed, scratch_dir(spark, f"{name}/sorted"))
    part = F.shiftright("_place", _LOW_BITS)
    counts = {r["part"]: r["n"] for r in
              written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [0] * (max(counts, default=0) + 1), 0
    for number in range(len(before)):
        before[number] = total
        total += counts.get(number, 0)
    offsets = F.array(*[F.lit(b).cast("long") for b in before])
    in_part = F.col("_place").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    positioned = written.withColumn(
        position, F.element_at(offsets, (part + 1).cast("int")) + in_part).drop("_place")
    return positioned, total


def shuffle_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
