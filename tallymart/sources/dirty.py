"""The test tables with faults: what every kind of check has to find.

The faults are fixed functions of the keys, so the expected counts can be worked out from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.sources.testdata import TestTables

FAR = 1_000_000_000  # added to a key, it refers to nothing


class DirtyTables(TestTables):
    """NULL and duplicated keys, orphans, unknown and contradicting statuses, impossible prices and
    costs, missing and unexpected lifecycle times, wrong item counts."""

    def products(self) -> DataFrame:
        return super().products().selectExpr(
            "id",
            "if(id % 59 = 0, -cost, cost) AS cost",
            "category", "name", "brand",
            "if(id % 53 = 0, NULL, retail_price) AS retail_price",
            "department", "sku",
            f"if(id % 61 = 0, distribution_center_id + {FAR}, distribution_center_id)"
            " AS distribution_center_id",
        )

    def users(self) -> DataFrame:
        users = super().users().withColumn(
            "created_at", F.expr("if(id % 47 = 0, NULL, created_at)"))
        return users.unionByName(users.filter("id % 113 = 5"))

    def _headers(self) -> DataFrame:
        return super()._headers().selectExpr(
            "order_id",
            f"CASE order_id % 83 WHEN 3 THEN user_id + {FAR} WHEN 4 THEN NULL ELSE user_id END"
            " AS user_id",
            "if(order_id % 97 = 5, 'Lost', status) AS status",
            "placed",
            "if(order_id % 89 = 1, NULL, shipped) AS shipped",
            "delivered",
            "if(order_id % 31 = 2, coalesce(returned, placed), returned) AS returned",
        )

    def orders(self) -> DataFrame:
        return super().orders().withColumn(
            "num_of_item", F.expr("if(order_id % 41 = 0, num_of_item + 1, num_of_item)"))

    def order_items(self) -> DataFrame:
        return super().order_items().withColumns({
            "id": F.expr("CASE order_id % 67 WHEN 3 THEN NULL"
                         " WHEN 4 THEN concat('line-', order_id) ELSE id END"),
            "order_id": F.expr(f"if(order_id % 103 = 0, order_id + {FAR}, order_id)"),
            "status": F.expr("if(order_id % 71 = 2, 'Returned', status)"),
            "sale_price": F.expr("CASE product_id % 101 WHEN 1 THEN -sale_price WHEN 2 THEN 1.0D"
                                 " WHEN 3 THEN NULL ELSE sale_price END"),
        })

    def events(self) -> DataFrame:
        return super().events().withColumns({
            "id": F.expr("CASE id % 43 WHEN 1 THEN NULL WHEN 2 THEN id - 2 ELSE id END"),
            "created_at": F.expr("if(id % 37 = 0, NULL, created_at)"),
        })


def spoiled_daily(daily: DataFrame) -> DataFrame:
    """Daily KPIs with more buyers than orders on every 13th of a month."""
    return daily.withColumn("active_customers", F.expr(
        "if(day(order_date) = 13, net_orders + 1, active_customers)"))


def spoiled_recognition(recognition: DataFrame) -> DataFrame:
    """Revenue recognition that is off by one on every 13th of a month."""
    return recognition.withColumn("recon_check", F.expr(
        "if(day(order_date) = 13, recon_check + 1, recon_check)"))
