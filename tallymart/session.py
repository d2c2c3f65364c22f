"""Spark session settings that the jobs in this package rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings. Lookup joins keep one row per key on the right, so a hot key only ever
# inflates the left side; AQE splits such a partition by map output and replicates the matching
# right partition. "force" lets it do so even where the join output feeds a groupBy on the same
# key: the extra exchange it then inserts carries map-side combined rows.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
}
# Static: without call-site capture, building a column costs one round trip to the JVM, not several.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# One shuffle partition per this many input splits (128 MB each by default): the columns a query
# keeps are a fraction of the files.
SPLITS_PER_PARTITION = 4


def tune(spark: SparkSession, *inputs: DataFrame, ceiling: int | None = None) -> SparkSession:
    """Apply the adaptive-execution settings to a session; call it once, before the first query.

    No query of this package changes the session. Only runtime SQL settings are touched: memory,
    cores and the session time zone stay with whoever created the session. Given the ``inputs``
    that the queries to come will read, shuffles start with a number of partitions that follows
    their size (never fewer than ``spark.sql.shuffle.partitions``); AQE merges those that stay
    small. ``ceiling`` bounds that number where the driver's map-output bookkeeping asks for it;
    past it partitions grow, and sorts and hash aggregates spill.
    """
    for key, value in ADAPTIVE_CONF.items():
        spark.conf.set(key, value)
    if inputs:
        spark.conf.set(_INITIAL_PARTITIONS, str(initial_partitions(
            input_splits=sum(df.rdd.getNumPartitions() for df in inputs),
            configured=int(spark.conf.get("spark.sql.shuffle.partitions")),
            ceiling=ceiling,
        )))
    return spark


def initial_partitions(input_splits: int, configured: int, ceiling: int | None = None) -> int:
    """Shuffle partitions to start with for inputs of so many splits."""
    by_size = input_splits // SPLITS_PER_PARTITION
    return max(configured, by_size if ceiling is None else min(by_size, ceiling))


def local_session(cpus: int | str = "*", app: str = "tallymart", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**ADAPTIVE_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
