"""UTC handling that does not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def naive_literal(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` constant; ``lit`` would make an instant of it in the session zone."""
    return F.expr(f"timestamp_ntz'{value.isoformat(sep=' ')}'")


def to_utc(instant: Column) -> Column:
    """Naive UTC wall clock (``timestamp_ntz``) of an instant; NULL stays NULL.

    A plain cast would use the session zone and fold two instants into one wall clock when that
    zone leaves daylight saving time.
    """
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(instant.cast("timestamp")), naive_literal(dt.datetime(1970, 1, 1))
    )


def utc_instant(naive: Column) -> Column:
    """The instant (``timestamp``) whose UTC wall clock is ``naive``; inverse of :func:`to_utc`."""
    day = F.unix_date(naive.cast("date")).cast("bigint") * F.lit(86_400_000_000)
    hours = F.hour(naive).cast("bigint") * F.lit(3_600_000_000)
    minutes = F.minute(naive).cast("bigint") * F.lit(60_000_000)
    seconds = (F.extract(F.lit("SECOND"), naive) * F.lit(1_000_000)).cast("bigint")
    return F.timestamp_micros(day + hours + minutes + seconds)


def month_of(day: Column) -> Column:
    """First day of the calendar month, as a date."""
    return F.trunc(day, "month").cast("date")


def period_of(day: Column, grain: str) -> Column:
    """Start of the period a date falls in; ``grain`` is day, month or all."""
    if grain == "day":
        return day.cast("date")
    if grain == "month":
        return month_of(day)
    if grain == "all":
        return F.lit(None).cast("date")
    raise ValueError(f"grain must be day, month or all, not {grain!r}")
