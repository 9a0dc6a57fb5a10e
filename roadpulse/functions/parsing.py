"""Lenient conversions: one bad field never loses its row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(c: Column) -> Column:
    """Integer part of a number or integer text; anything else is 0."""
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def safe_float(c: Column, default: float = 0.0, *, finite: bool = False) -> Column:
    """Number or numeric text; anything else is ``default``. ``finite`` also rejects NaN and infinity."""
    number = c.try_cast("double")
    if finite:
        number = F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    return F.coalesce(number, F.lit(float(default)))


def parse_ts(text: Column) -> Column:
    """ISO-8601 text (with ``Z``, an offset, or none, read as UTC; also the compact form); else null.

    The date check keeps out bare times and years, which a plain cast accepts.
    """
    dashed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    compact = F.when(
        text.rlike(r"^\d{8}T\d{6}$"),
        F.try_to_timestamp(text, F.lit("yyyyMMdd'T'HHmmss")),
    )
    return F.coalesce(dashed, compact)


def minute_bucket(ts: Column) -> Column:
    return F.date_trunc("minute", ts)
