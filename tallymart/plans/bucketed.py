"""Tables laid out for their joins: lines and orders bucketed by order, customers by customer.

Bucketing pays the shuffle once, when a table is written. Joins and groupings on the bucket key then
read matching buckets side by side: line enrichment and order rollup move neither lines nor orders,
and the customer dimension moves neither orders nor customers. The catalogue is looked up by another
key; Catalyst broadcasts it while it is small, and beyond that its join moves the lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.plans import marts
from tallymart.plans.layers import Layers

# Staged table -> key of its buckets.
KEYS = {"orders": "order_id", "order_items": "order_id", "users": "user_id"}
ORDER_FACT_KEY = "user_id"
BUCKETS = 64
# One task reads one bucket, so their number follows the rows of the largest table.
ROWS_PER_BUCKET = 500_000


def buckets_for(rows: int, at_least: int = BUCKETS) -> int:
    """Buckets of a table of so many rows; tables that are joined need the same number."""
    return max(at_least, -(-rows // ROWS_PER_BUCKET))


def write_bucketed(frame: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``frame`` as a catalogue table with sorted buckets of ``key``, and return it.

    Rows are dealt by the key first, so that each bucket is one file and not one per task.
    """
    (frame.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
     .option("path", path).format("parquet").saveAsTable(table))
    return frame.sparkSession.table(table)


def bucketed_layers(layers: Layers, database: str, root: str, buckets: int = BUCKETS) -> Layers:
    """The same layers over bucketed copies of the staged tables and of the order fact.

    ``root`` is a folder that all executors reach; ``buckets`` should follow the table size, as one
    task reads one bucket.
    """
    spark: SparkSession = layers.fct_orders.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def written(frame: DataFrame, name: str, key: str) -> DataFrame:
        return write_bucketed(frame, f"{database}.{name}", key, buckets, f"{root}/{name}")

    staged = {name: written(layers.staged(name), f"stg_{name}", key) for name, key in KEYS.items()}
    over_staged = Layers(layers.raw, staged=staged)
    orders = written(marts.fct_orders(over_staged.order_enriched), "fct_orders", ORDER_FACT_KEY)
    return Layers(layers.raw, written_orders=orders, staged=staged)
