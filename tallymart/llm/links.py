"""Connected components of a link table, by alternating star contractions.

Every round hangs each node below the smallest node among its neighbours, first for the larger
neighbours (large star), then for the smaller ones (small star), until the links form stars. Each
round is written to the scratch folder, which cuts the lineage; only one count and one checksum per
round reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.workspace import scratch_dir, write_and_read

SALTS = 16  # shares of a node's links


def local_forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, root of each) that connect what the symmetric link matrix ``near`` connects."""
    n = len(near)
    label = np.arange(n)
    while True:
        lower = np.minimum(label, np.where(near, label[None, :], n).min(axis=1, initial=n))
        lower = lower[lower]
        if np.array_equal(lower, label):
            moved = np.flatnonzero(label != np.arange(n))
            return moved, label[moved]
        label = lower


def _large_star(links: DataFrame) -> DataFrame:
    """The larger neighbours of every node move to its smallest neighbour or itself.

    A node with very many larger neighbours is the usual case, the root of a large component. Its
    links are dealt by a salt, and the root, one row per node that has larger neighbours, goes to
    every salt.
    """
    lowest = links.groupBy("node").agg(F.min("below").alias("lowest"))
    centres = links.select(F.col("below").alias("centre")).distinct()
    roots = (
        centres.join(lowest, F.col("centre") == F.col("node"), "left")
        .select("centre", F.coalesce("lowest", "centre").alias("root"),
                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("to"))
    )
    dealt = links.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    met = (F.col("below") == F.col("centre")) & (F.col("salt") == F.col("to"))
    return dealt.join(roots, met).select("node", F.col("root").alias("below")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of every node, and the node itself, move to the smallest of them."""
    lowest = links.groupBy("node").agg(F.min("below").alias("root"))
    moved = links.join(lowest, "node").select(F.col("below").alias("node"),
                                              F.col("root").alias("below"))
    moved = moved.where(F.col("node") != F.col("below"))
    return moved.unionByName(lowest.withColumnRenamed("root", "below")).distinct()


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) of every linked node; root is the smallest node of its component.

    ``links`` has two bigint columns, a and b. Links with a NULL end and links of a node to itself
    say nothing; repeated and reversed links count once.
    """
    spark = links.sparkSession
    folder = scratch_dir(spark, name)
    current = write_and_read(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("below")).distinct(),
        f"{folder}/round0")
    before, number = None, 0
    while True:
        check = current.agg(F.count("*").alias("n"),
                            F.sum(F.xxhash64("node", "below").cast("decimal(38,0)")).alias("h"))
        state = tuple(check.first())
        if state == before or state[0] == 0:
            return current.select("node", F.col("below").alias("root"))
        before, number = state, number + 1
        current = write_and_read(_small_star(_large_star(current)),
                                 f"{folder}/round{number}")
