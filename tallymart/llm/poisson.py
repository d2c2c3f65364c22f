"""Mixing sources to target weights by Poisson replication.

A source with ``n`` documents and target share ``w`` of ``total`` output rows has the repetition
rate ``w * total / n``. Every document draws its count from the Poisson distribution with that
mean: a uniform number made from a hash of the seed and the document is put through the inverse of
the distribution function. Documents are exploded by their counts and the copies put in the order of
another hash. The draw depends on the document alone, not on partitions, order or retries, and the
expected number of rows per source is exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.ranks import shuffle_partitions

SEED = 17
# Shares of sources without a declared weight follow count ** TEMPERATURE: below 1, rare sources
# are repeated and frequent ones thinned.
TEMPERATURE = 0.5
# Rows of the source table that may be broadcast; beyond it Spark chooses a shuffle join.
BROADCAST_SOURCES = 10_000
HEX_DIGITS = 13  # 52 bits, exact in a double


def hashed(hex_digits: int, *parts: Column) -> Column:
    """A non-negative long from the first digits of the parts' MD5."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    return (hashed(HEX_DIGITS, *parts) + F.lit(0.5)) / F.lit(float(16 ** HEX_DIGITS))


def inverse_poisson(u: Column, mean: Column) -> Column:
    """The smallest k whose Poisson distribution function is at least u.

    Terms are computed from logarithms, so that large means do not underflow. The search covers
    twelve standard deviations above the mean, past what a 52-bit uniform number can reach.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")

    def add(state: Column, k: Column) -> Column:
        log_term = F.when(k == 0, -mean).otherwise(
            state["log_term"] + F.log(mean) - F.log(k.cast("double")))
        below = state["below"] + F.exp(log_term)
        return F.struct(
            log_term.alias("log_term"), below.alias("below"),
            (state["k"] + (below < u).cast("int")).alias("k"))

    start = F.struct(F.lit(0.0).alias("log_term"), F.lit(0.0).alias("below"),
                     F.lit(0).alias("k"))
    drawn = F.aggregate(F.sequence(F.lit(0), last), start, add, lambda s: s["k"])
    return F.when(mean > 0, drawn).otherwise(F.lit(0))


def source_rates(documents: DataFrame, weights: Mapping[str, float] | None, total: int | None,
                 temperature: float) -> DataFrame:
    """source and its repetition rate; one row per source, NULL being a source of its own."""
    counts = documents.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        declared = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        known = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) \
            if weights else F.lit(None).cast("map<string,double>")
        declared = F.coalesce(F.element_at(known, F.col("source")).cast("double"), F.lit(0.0))
    weighed = counts.withColumn("weight", declared)
    all_weight, all_rows = weighed.agg(F.sum("weight"), F.sum("n")).first()  # two numbers
    rows = float(total if total is not None else all_rows or 0)
    rate = (F.col("weight") / F.lit(float(all_weight)) * F.lit(rows) / F.col("n")
            if all_weight else F.lit(0.0))
    return weighed.select("source", rate.alias("rate"))


def _copies(documents: DataFrame, weights: Mapping[str, float] | None, total: int | None,
            temperature: float, seed: int) -> DataFrame:
    """row (a struct of all columns), rate, copies, copy and shuffle_key, in shuffled order.

    Rows travel as one struct, so that no column of theirs can clash with another one.
    """
    spark = documents.sparkSession
    rates = source_rates(documents, weights, total, temperature)
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("string"), F.concat(
            F.lit("#"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))).alias("doc"))
    sourced = rows.join(F.broadcast(rates) if few else rates,
                        F.col("row.source").eqNullSafe(F.col("source")))
    drawn = sourced.withColumn(
        "copies", inverse_poisson(uniform(F.lit(str(seed)), F.col("doc")), F.col("rate")))
    copied = drawn.where(F.col("copies") > 0).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    keyed = copied.withColumn(
        "shuffle_key", hashed(15, F.lit(str(seed)), F.col("doc"), F.col("copy").cast("string")))
    # Hashed keys deal evenly without sampling the texts first; the sort orders each part.
    return keyed.repartition(shuffle_partitions(spark), "shuffle_key").sortWithinPartitions(
        "shuffle_key", "row.doc_id", "copy").select("row", *ADDED)


ADDED = ("rate", "copies", "copy", "shuffle_key")


def mix(documents: DataFrame, weights: Mapping[str, float] | None = None,
        total: int | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Columns of ``documents`` (doc_id, text, source and whatever else), and rate, copies, copy and
    shuffle_key, in shuffled order.

    ``weights`` are target weights by source (sources that it leaves out get none); without them
    weights follow the temperature. ``total`` is the expected number of rows, by default that of
    ``documents``.

    Defined cases: a NULL source is a source of its own, without weight if weights are declared;
    NULL texts take part like others; rows without an id draw by their text; repeated rows draw the
    same count, as they cannot be told apart; an empty table gives an empty result; columns named
    like a result column are replaced by it (:func:`mixed` keeps them).
    """
    own = [c for c in documents.columns if c.lower() not in ADDED]
    copies = _copies(documents, weights, total, temperature, seed)
    return copies.select(*[F.col("row").getField(c).alias(c) for c in own], *ADDED)


def mixed(documents: DataFrame, weights: Mapping[str, float] | None = None,
          total: int | None = None) -> DataFrame:
    """The copies alone, with the columns of ``documents`` and their values."""
    copies = _copies(documents, weights, total, TEMPERATURE, SEED)
    return copies.select(*[F.col("row").getField(c).alias(c) for c in documents.columns])
