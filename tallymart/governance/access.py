"""Role-scoped, read-only views of the marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.plans import business
from tallymart.specs import PII_COLUMNS, PII_TAG

# Subject -> how it is derived from the marts. Customer-level money stays out of the KPI set.
SUBJECTS: dict[str, Callable[[Callable[[str], DataFrame]], DataFrame]] = {
    "daily_kpis": lambda mart: mart("fct_daily_kpis"),
    "products": lambda mart: mart("dim_products"),
    "orders_by_status": lambda mart: business.orders_by_status(mart("fct_orders")),
    "repeat_purchase_rate": lambda mart: business.repeat_purchase_rate(mart("dim_customers")),
    "revenue_recognition": lambda mart: mart("fct_revenue_recognition"),
    "top_customers": lambda mart: business.top_customers_ltv(mart("dim_customers")),
}
KPI_SET = ("daily_kpis", "products", "orders_by_status", "repeat_purchase_rate")
FINANCE_SET = ("revenue_recognition", "top_customers")

# Role -> subjects it may read (fixed values). A role that is not named here gets the KPI set.
ROLES = {
    "administrators": KPI_SET + FINANCE_SET,
    "finance": KPI_SET + FINANCE_SET,
    "marketing": KPI_SET,
}


class AccessDenied(Exception):
    """The role may not read the subject."""


def tag_pii(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Mark columns as personal, in the metadata of their fields.

    The tag follows a column through renames, joins, unions of tagged tables and Parquet files. An
    expression over a column has no tag: whoever computes one from personal data tags the result.
    """
    wanted = set(columns)
    for field in df.schema.fields:
        if field.name in wanted:
            df = df.withMetadata(field.name, {**field.metadata, PII_TAG: True})
    return df


def personal_columns(df: DataFrame) -> list[str]:
    """Columns that are tagged as personal, and untagged ones that bear a declared name."""
    return [f.name for f in df.schema.fields
            if f.metadata.get(PII_TAG, f.name.lower() in PII_COLUMNS)]


def without_pii(df: DataFrame) -> DataFrame:
    """Drop the columns that identify a person or a device, whatever they are called by now."""
    personal = set(personal_columns(df))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in personal])


def subjects_of(role: str) -> tuple[str, ...]:
    return ROLES.get(role, KPI_SET)


def read_subject(role: str, subject: str, mart: Callable[[str], DataFrame]) -> DataFrame:
    """One subject as the role sees it."""
    if subject not in subjects_of(role):
        raise AccessDenied(f"{role} may not read {subject}")
    return without_pii(SUBJECTS[subject](mart))


def register_views(role: str, mart: Callable[[str], DataFrame]) -> list[str]:
    """Temporary views ``<role>_<subject>`` over everything the role may read."""
    names = []
    for subject in subjects_of(role):
        name = f"{role}_{subject}"
        read_subject(role, subject, mart).createOrReplaceTempView(name)
        names.append(name)
    return names
