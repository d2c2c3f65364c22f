"""The revenue ladder, guarded ratios and presentation rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Which order-line statuses each rung of the ladder leaves out or keeps (fixed values).
NOT_GROSS = ("Cancelled",)
NOT_NET = ("Cancelled", "Returned")
REFUNDED = ("Returned",)
RECOGNIZED = ("Shipped", "Complete")

AMOUNTS = ("gross_amount", "net_amount", "refund_amount", "recognized_amount")


def ladder_flags(status: Column) -> dict[str, Column]:
    """Ladder membership of a line; an unknown (NULL) status gives NULL flags."""
    return {
        "is_gross": ~status.isin(*NOT_GROSS),
        "is_net": ~status.isin(*NOT_NET),
        "is_refund": status.isin(*REFUNDED),
        "is_recognized": status.isin(*RECOGNIZED),
    }


def with_revenue_ladder(lines: DataFrame) -> DataFrame:
    """Add flags and amounts to lines that carry ``status`` and ``sale_price``.

    This is the only place that turns a status into money. A line with a NULL status earns 0 on
    every rung, while its price still counts as demand.
    """
    price = F.col("sale_price")
    flags = ladder_flags(F.col("status"))
    amounts = {
        name.replace("is_", "") + "_amount": F.when(flag, price).otherwise(F.lit(0.0))
        for name, flag in flags.items()
    }
    return lines.withColumns({**flags, **amounts})


def net_margin(is_net: Column, price: Column, cost: Column) -> Column:
    """Margin of a net line, 0 for other lines, NULL for a net line of unknown cost."""
    return F.when(is_net, price - cost).otherwise(F.lit(0.0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL unless the denominator is positive."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator))


def dollars(amount: Column, digits: int = 0) -> Column:
    """Round an amount for display.

    Rounding to cents first removes the noise that summing doubles in any order leaves, so that a
    half dollar always rounds the same way.
    """
    cents = F.round(amount, 2)
    return cents if digits >= 2 else F.round(cents, digits)
