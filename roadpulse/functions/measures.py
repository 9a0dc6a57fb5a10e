"""Traffic measures as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.functions.parsing import safe_float, safe_int
from roadpulse.functions.text import first_text, strip
from roadpulse.schemas import CLASS_FIELDS, HEAVY_FIELDS

KM_PER_MILE = 1.60934

# Reads one payload field as a SQL type: ``field("road_id", "string")``.
Field = Callable[[str, str], Column]


def link_length_km(kilometers: Column, miles: Column) -> Column:
    """Kilometres if positive, else converted miles; never negative or NaN."""
    km = F.nanvl(safe_float(kilometers), F.lit(0.0))
    from_miles = F.nanvl(safe_float(miles), F.lit(0.0)) * KM_PER_MILE
    return F.when(km > 0, km).otherwise(F.greatest(from_miles, F.lit(0.0)))


def heavy_count(field: Field, fallback: str = "zero") -> Column:
    """The heavy total if present. If absent: 0 (``zero``) or the six axle classes (``sum6``)."""
    if fallback == "sum6":
        other = reduce(add, [safe_int(field(name, "bigint")) for name in HEAVY_FIELDS])
    elif fallback == "zero":
        other = F.lit(0).cast("bigint")
    else:
        raise ValueError(f"unknown heavy fallback: {fallback}")
    name = "all_heavy_goods_vehicle_count"
    return F.when(field(name, "string").isNull(), other).otherwise(safe_int(field(name, "bigint")))


def vehicle_count(field: Field) -> Column:
    """The motor vehicle total if positive, else the sum of the positive class counts."""
    total = safe_float(field("all_motor_vehicle_count", "double"))
    zero = F.lit(0.0)
    by_class = reduce(add, [F.greatest(safe_float(field(n, "double")), zero) for n in CLASS_FIELDS])
    return F.when((total > 0) & ~F.isnan(total), total).otherwise(by_class)


def direction_of(field: Field) -> Column:
    return first_text(*[
        strip(field(n, "string")) for n in ("direction", "direction_of_travel", "travel_direction")
    ])


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """``part / whole``; 0 when the whole is null, zero or negative."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def round_half_even(c: Column) -> Column:
    return F.bround(c).cast("bigint")
