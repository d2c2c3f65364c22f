"""Hilbert-curve sharding on DataFrame functions alone.

Documents are ordered along a Hilbert curve over quantised metadata (language, source, size), and
the curve is cut into runs of equal row counts, so that a filter on any mix of the dimensions
touches few shards. Each dimension becomes a number that keeps its order, is cut at quantiles of
all rows into ``2**bits`` cells, and the cells are looked up in a table of the curve whose size,
``2**(dimensions * bits)`` rows, does not depend on the data.

Defined cases: NULL in a dimension sorts before every value (cell 0); a NULL text has no bytes; rows
that agree in every sort key are interchangeable; an empty table gives an empty result; further
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymart.llm.common import utf8_bytes, utf8_crc32
from tallymart.llm.ranks import shuffle_partitions, with_positions
from tallymart.workspace import scratch_dir, write_and_read

SHARDS = 24
BITS = 5
LAW = "rows"
ROW_OVERHEAD = 8  # bytes per document beside its text
QUANTILE_ACCURACY = 10_000
RUN = 4096  # distinct strings whose counts one window sums up


def string_edges(rows: DataFrame, dimension: str, cells: int) -> list[str]:
    """Distinct values of a string dimension at the inner of ``cells`` quantiles of its rows.

    Whole values are compared. Rows are counted per value, and the counts are summed up in runs of
    ``RUN`` values, so that no task sees all values.
    """
    spark = rows.sparkSession
    counts = rows.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias("value")).agg(
        F.count("*").alias("n"))
    placed, _ = with_positions(counts, ["value"], shuffle_partitions(spark), f"hilbert/{dimension}")
    runs = placed.withColumn("run", F.expr(f"position div {RUN}"))
    whole = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("run").agg(F.sum("n").alias("in_run"))
    total = sums.agg(F.coalesce(F.sum("in_run"), F.lit(0))).first()[0]
    starts = sums.withColumn("start", F.coalesce(F.sum("in_run").over(whole), F.lit(0)))
    within = Window.partitionBy("run").orderBy("position")
    upto = F.col("start") + F.sum("n").over(within)
    summed = runs.join(starts.select("run", "start"), "run").withColumn("upto", upto)
    # Quantile i lies at a value when i * total / cells is beyond the rows before it, not its own.
    last = F.least(F.expr(f"upto * {cells} div {max(total, 1)}"), F.lit(cells - 1))
    before = F.expr(f"(upto - n) * {cells} div {max(total, 1)}")
    return [r["value"] for r in summed.where(last > before).select("value").collect()]


def curve(spark: SparkSession, dimensions: int, bits: int) -> DataFrame:
    """``cell`` (the coordinates' bits side by side) and its ``h``, its index on the curve.

    The coordinates are transposed bit by bit from the highest plane down: where a coordinate's bit
    is set the lower planes of the first one are inverted, otherwise they are exchanged with that
    coordinate's; a Gray decoding of the planes then yields the index.
    """
    mask = (1 << bits) - 1
    cells = spark.range(1 << (dimensions * bits)).withColumnRenamed("id", "cell")
    axes = [f"x{i}" for i in range(dimensions)]
    for i, axis in enumerate(axes):
        shift = bits * (dimensions - 1 - i)
        cells = cells.withColumn(axis, F.shiftright("cell", shift).bitwiseAND(F.lit(mask)))
    for plane in range(bits - 1, 0, -1):
        low = F.lit((1 << plane) - 1)
        for axis in axes:
            is_set = F.shiftright(axis, plane).bitwiseAND(F.lit(1)) == 1
            swap = F.col("x0").bitwiseXOR(F.col(axis)).bitwiseAND(low)
            first = F.when(is_set, F.col("x0").bitwiseXOR(low))
            if axis == "x0":
                cells = cells.withColumn("x0", first.otherwise(F.col("x0")))
            else:
                cells = cells.withColumns({
                    "x0": first.otherwise(F.col("x0").bitwiseXOR(swap)),
                    axis: F.when(is_set, F.col(axis)).otherwise(F.col(axis).bitwiseXOR(swap)),
                })
    for before, axis in zip(axes, axes[1:]):
        cells = cells.withColumn(axis, F.col(axis).bitwiseXOR(F.col(before)))
    last, turn = F.col(axes[-1]), F.lit(0).cast("long")
    for plane in range(bits - 1, 0, -1):
        turn = turn.bitwiseXOR(F.when(F.shiftright(last, plane).bitwiseAND(F.lit(1)) == 1,
                                      F.lit((1 << plane) - 1)).otherwise(F.lit(0)).cast("long"))
    cells = cells.withColumn("turn", turn)
    index = F.lit(0).cast("long")
    for plane in range(bits - 1, -1, -1):
        for axis in axes:
            bit = F.shiftright(F.col(axis).bitwiseXOR(F.col("turn")), plane)
            index = F.shiftleft(index, 1).bitwiseOR(bit.bitwiseAND(F.lit(1)))
    return cells.select("cell", index.alias("h"))


def quantised(rows: DataFrame, dimensions: list[str], bits: int) -> Column:
    """The cell of each row; cut points are quantiles over all rows, one small row per table."""
    inner = [i / (1 << bits) for i in range(1, 1 << bits)]
    texts = [d for d in dimensions if rows.schema[d].dataType == StringType()]
    [found] = rows.agg(*[F.percentile_approx(d, inner, QUANTILE_ACCURACY).alias(d)
                         for d in dimensions if d not in texts]).collect()
    cuts = found.asDict() | {d: string_edges(rows, d, 1 << bits) for d in texts}

    def coordinate(dimension: str) -> Column:
        edges = sorted(set(cuts[dimension] or []))
        above = [(F.col(dimension) >= edge).cast("long") for edge in edges]
        # Few distinct values are spread over the whole axis, so that they part the curve early.
        step = (1 << bits) // (len(edges) + 1)
        rank = reduce(lambda a, b: a + b, above, F.lit(0).cast("long"))
        return F.coalesce(rank * step, F.lit(0).cast("long"))

    return reduce(lambda code, d: F.shiftleft(code, bits) + coordinate(d), dimensions,
                  F.lit(0).cast("long"))


def shard(documents: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    Shards are runs of the curve whose row counts differ by one at most. Equal texts of one source
    and language lie side by side.
    """
    spark = documents.sparkSession
    slim = documents.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + ROW_OVERHEAD).alias("size"),
        utf8_crc32(F.col("text")).alias("text_crc32"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    # One scan of the texts; everything after it reads a few numbers per document.
    slim = write_and_read(slim, scratch_dir(spark, "hilbert/slim"))
    dimensions = ["lang", "source", "size"]
    cells = slim.withColumn("cell", quantised(slim, dimensions, bits))
    # The curve has 2**(3 * bits) rows, so its broadcast is bounded by the parameter.
    on_curve = cells.join(F.broadcast(curve(spark, len(dimensions), bits)), "cell")
    placed, total = with_positions(
        on_curve.select("h", "text_crc32", "doc_id", "size"),
        ["h", "text_crc32", "doc_id", "size"], shuffle_partitions(spark), "hilbert")
    total = max(total, 1)
    # Shard s holds the positions from floor(s * total / shards) on.
    cut = placed.withColumn("shard", F.expr(f"((position + 1) * {shards} - 1) div {total}"))
    first = F.expr(f"(shard * {total}) div {shards}")
    return cut.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

