"""The seven raw tables, derived from TPC-H-style Parquet tables.

Stand-in for a commerce system: the mapping is deterministic and keeps the guarantees a real feed
has (line status equals order status, lifecycle timestamps follow the status, price >= cost).
A line's id is text made of its four keys, so that ids of different lines never meet.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.timestamps import utc_instant
from tallymart.specs import RAW_TABLES
from tallymart.workspace import scratch_dir, write_and_read

_HOUR_US = 3_600_000_000
_DAY_US = 24 * _HOUR_US

# Market segment -> acquisition channel (fixed values).
_CHANNEL = """
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Search' WHEN 'BUILDING' THEN 'Organic'
         WHEN 'FURNITURE' THEN 'Facebook' WHEN 'HOUSEHOLD' THEN 'Email'
         WHEN 'MACHINERY' THEN 'Display' END"""

# Order state and priority -> lifecycle status.
_STATUS = """
    CASE WHEN o_orderstatus = 'F'
         THEN if(o_orderpriority = '1-URGENT', 'Returned', 'Complete')
         WHEN o_orderstatus = 'O' THEN 'Shipped'
         WHEN o_orderstatus = 'P' THEN if(o_orderpriority = '5-LOW', 'Cancelled', 'Processing')
    END"""

_LINE_ID = "concat_ws('-', order_id, l_linenumber, l_partkey, l_suppkey)"


class TestTables(Mapping):
    """Raw-shaped frames over one directory of Parquet tables, by raw table name.

    A frame is built when it is first looked up.
    """

    __test__ = False

    def __init__(self, spark: SparkSession, directory: str):
        self._spark = spark
        self._directory = directory.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._frames: dict[str, DataFrame] = {}
        self._written_lines: DataFrame | None = None
        self.written_to: str | None = None  # the folder of the written lines

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_TABLES:
            raise KeyError(name)
        if name not in self._frames:
            self._frames[name] = getattr(self, name)()
        return self._frames[name]

    def __iter__(self):
        return iter(RAW_TABLES)

    def __len__(self) -> int:
        return len(RAW_TABLES)

    def read(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self._spark.read.parquet(f"{self._directory}/{table}.parquet")
        return self._tables[table]

    def distribution_centers(self) -> DataFrame:
        return self.read("nation").selectExpr(
            "cast(n_nationkey AS bigint) AS id",
            "n_name || ' DC ' AS name",
            "n_nationkey * 1.0D AS latitude",
            "n_nationkey * -2.0D AS longitude",
        )

    def products(self) -> DataFrame:
        return self.read("part").selectExpr(
            "p_partkey AS id",
            "round(p_retailprice * 0.6D, 2) AS cost",
            "p_type AS category",
            "' ' || p_name || ' ' AS name",
            "p_brand AS brand",
            "p_retailprice AS retail_price",
            "if(p_size % 2 = 0, 'Men', 'Women') AS department",
            "'SKU-' || p_partkey AS sku",
            "p_partkey % 25 AS distribution_center_id",
        )

    def users(self) -> DataFrame:
        # Nation and region are fixed lists of 25 and 5 rows: Catalyst broadcasts them.
        places = self.read("nation").join(
            self.read("region"), F.expr("n_regionkey = r_regionkey"), "left"
        )
        customers = self.read("customer").join(
            places, F.expr("c_nationkey = n_nationkey"), "left"
        )
        return customers.selectExpr(
            "c_custkey AS id",
            "' ' || c_name AS first_name",
            "c_mktsegment AS last_name",
            "' USER' || c_custkey || '@Example.COM ' AS email",
            "cast(18 + c_custkey % 58 AS int) AS age",
            "if(c_custkey % 2 = 0, 'F', 'M') AS gender",
            "r_name AS state",
            "c_custkey || ' Main St' AS street_address",
            "lpad(cast(c_custkey % 100000 AS string), 5, '0') AS postal_code",
            "n_name AS city",
            "'United States' AS country",
            "c_custkey % 180 - 90.0D AS latitude",
            "c_custkey % 360 - 180.0D AS longitude",
            f"{_CHANNEL} AS traffic_source",
            "timestamp_micros((unix_date(DATE'1994-01-01') + c_custkey % 365)"
            f" * {_DAY_US}) AS created_at",
        )

    def _headers(self) -> DataFrame:
        """Orders with status and lifecycle times as microseconds since the epoch, UTC.

        The order date is a calendar date; the hour of the day comes from the order key.
        """
        placed = (
            f"unix_date(cast(o_orderdate AS date)) * {_DAY_US} + o_orderkey % 24 * {_HOUR_US}"
        )
        steps = {
            "shipped": ("placed", 3, "'Shipped', 'Complete', 'Returned'"),
            "delivered": ("shipped", 5, "'Complete', 'Returned'"),
            "returned": ("delivered", 14, "'Returned'"),
        }
        headers = self.read("orders").selectExpr(
            "o_orderkey AS order_id", "o_custkey AS user_id",
            f"{_STATUS} AS status", f"{placed} AS placed",
        )
        for step, (previous, spread, statuses) in steps.items():
            headers = headers.selectExpr(
                "*",
                f"CASE WHEN status IN ({statuses}) THEN "
                f"{previous} + (1 + order_id % {spread}) * {_DAY_US} END AS {step}",
            )
        return headers

    def orders(self) -> DataFrame:
        counts = (
            self.read("lineitem").withColumnRenamed("l_orderkey", "order_id")
            .groupBy("order_id").agg(F.expr("count(*) AS n_lines"))
        )
        naive = "timestampadd(MICROSECOND, {0}, timestamp_ntz'1970-01-01 00:00:00') AS {0}_at"
        return self._headers().join(counts, "order_id", "left").selectExpr(
            "order_id",
            "user_id",
            "status",
            "if(user_id % 2 = 0, 'F', 'M') AS gender",
            "timestamp_micros(placed) AS created_at",
            *[naive.format(step) for step in ("returned", "shipped", "delivered")],
            "cast(coalesce(n_lines, 0) AS int) AS num_of_item",
        )

    def with_written_lines(self, name: str) -> TestTables:
        """The same tables over a written join of lines and headers, which order_items and
        inventory_items share."""
        tables = type(self)(self._spark, self._directory)
        lines = self._lines().select(
            "order_id", "user_id", "status", "placed", "shipped", "delivered", "returned",
            "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
        tables.written_to = scratch_dir(self._spark, f"{name}/lines")
        tables._written_lines = write_and_read(lines, tables.written_to)
        return tables

    def _lines(self) -> DataFrame:
        """Line items with their order header; keyed on ``order_id`` from the join on, so a later
        grouping or join by order reuses the partitioning."""
        if self._written_lines is not None:
            return self._written_lines
        return (
            self.read("lineitem").withColumnRenamed("l_orderkey", "order_id")
            .join(self._headers(), "order_id")
        )

    def order_items(self) -> DataFrame:
        stamps = {"placed": "created_at", "shipped": "shipped_at",
                  "delivered": "delivered_at", "returned": "returned_at"}
        return self._lines().selectExpr(
            f"{_LINE_ID} AS id",
            "order_id",
            "user_id",
            "l_partkey AS product_id",
            f"{_LINE_ID} AS inventory_item_id",
            "status",
            *[f"timestamp_micros({step}) AS {name}" for step, name in stamps.items()],
            "l_extendedprice AS sale_price",
        )

    def inventory_items(self) -> DataFrame:
        copied = self.products().selectExpr(
            "id AS product_id", "cost",
            *[f"{c} AS product_{c}" for c in ("category", "name", "brand", "retail_price",
                                              "department", "sku", "distribution_center_id")],
        )
        units = self._lines().selectExpr(
            f"{_LINE_ID} AS id",
            "l_partkey AS product_id",
            f"timestamp_micros(placed - (5 + order_id % 56) * {_DAY_US}) AS created_at",
            "if(status <> 'Cancelled', timestamp_micros(placed), NULL) AS sold_at",
        )
        return units.join(copied, "product_id", "left").select(
            "id", "product_id", "created_at", "sold_at", "cost", "product_category",
            "product_name", "product_brand", "product_retail_price", "product_department",
            "product_sku", "product_distribution_center_id",
        )

    def events(self) -> DataFrame:
        return (
            self.read("events")
            .withColumn("created_at", utc_instant(F.col("ts")))
            .selectExpr(
                "event_id AS id",
                "if(event_id % 5 = 0, NULL, cast(user_id AS double)) AS user_id",
                "cast(1 + event_id % 10 AS int) AS sequence_number",
                "'s' || user_id || '-' || date_format(cast(ts AS date), 'yyyyMMdd')"
                " AS session_id",
                "created_at",
                "'10.0.0.1' AS ip_address",
                "'Springfield' AS city",
                "'IL' AS state",
                "'01234' AS postal_code",
                "elt(cast(1 + event_id % 4 AS int), 'Chrome', 'Safari', 'Firefox', 'Edge')"
                " AS browser",
                "elt(cast(1 + event_id % 5 AS int), 'Search', 'Organic', 'Facebook', 'Email',"
                " 'Display') AS traffic_source",
                "'/' || event_type AS uri",
                "event_type",
            )
        )
