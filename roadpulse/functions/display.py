"""Human-readable durations, sizes and usage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/D"
_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def humanize_seconds(c: Column, *, days: bool = True) -> Column:
    """``1d 2h 3m 4s``; below one second ``<1s``; null when negative or not a number.

    ``days=False`` lets the hours grow past 24.
    """
    seconds = c.try_cast("double")
    whole = F.floor(seconds).cast("bigint")
    hours = F.floor(whole / 3600).cast("bigint")
    parts = []
    if days:
        day = F.floor(whole / 86400).cast("bigint")
        parts.append(F.when(day > 0, F.concat(day, F.lit("d"))))
        hours = hours % 24
    minutes = F.floor(whole / 60).cast("bigint") % 60
    parts += [
        F.when(hours > 0, F.concat(hours, F.lit("h"))),
        F.when(minutes > 0, F.concat(minutes, F.lit("m"))),
        F.concat(whole % 60, F.lit("s")),
    ]
    return (
        F.when(seconds.isNull() | F.isnan(seconds) | (seconds < 0), F.lit(None).cast("string"))
        .when(seconds < 1, F.lit("<1s"))
        .otherwise(F.concat_ws(" ", *parts))
    )


def format_lag(c: Column) -> Column:
    return F.coalesce(humanize_seconds(c, days=False), F.lit(NOT_AVAILABLE))


def one_decimal(c: Column) -> Column:
    # Ties go to the even digit; the size steps are exact binary fractions.
    return F.when(c.isNotNull(), F.format_string("%.1f", F.bround(c, 1)))


def format_bytes(c: Column, *, sep: str = "") -> Column:
    """Steps of 1024, one decimal. Negative sizes count as 0."""
    size = F.greatest(c.try_cast("double"), F.lit(0.0))
    out = None
    for power, unit in enumerate(_UNITS):
        text = F.concat(one_decimal(size / float(1024**power)), F.lit(sep + unit))
        if unit == _UNITS[-1]:
            return F.when(size.isNull() | F.isnan(size), F.lit(None).cast("string")).otherwise(
                out.otherwise(text)
            )
        below = size < float(1024 ** (power + 1))
        out = F.when(below, text) if out is None else out.when(below, text)
    return out


def format_size(c: Column) -> Column:
    """As :func:`format_bytes` with a space, ``N/D`` for missing or negative sizes."""
    size = c.try_cast("double")
    return F.coalesce(F.when(size >= 0, format_bytes(size, sep=" ")), F.lit(NOT_AVAILABLE))


def format_usage(used: Column, total: Column, percent: Column) -> Column:
    """``used / total (pct%)``; the percentage is computed when it is missing."""
    u, t = used.try_cast("double"), total.try_cast("double")
    given = F.when(~F.isnan(percent.try_cast("double")), percent.try_cast("double"))
    pct = F.coalesce(given, u / F.nullif(t, F.lit(0.0)) * 100)
    text = F.concat(
        format_size(u), F.lit(" / "), format_size(t), F.lit(" ("), one_decimal(pct), F.lit("%)")
    )
    return F.coalesce(F.when(t > 0, text), F.lit(NOT_AVAILABLE))
