"""Gold rows of any vintage to the records the analytic queries read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.aggregates import unpivot
from roadpulse.functions.measures import ratio_or_zero
from roadpulse.functions.parsing import parse_ts
from roadpulse.operators.events import TIME_FIELDS
from roadpulse.schemas import CLASS_FIELDS, CLASS_GOLD, VEHICLE_CLASSES

# Columns that may hold a measure, best first.
TOTAL_NAMES = ("all_motor_vehicle_count", "all_motor_vehicles", "total_vehicles")
DENSITY_NAMES = ("vehicles_per_kilometer", "vehicles_per_km", "density")
HEAVY_NAMES = ("all_heavy_goods_vehicle_count", "all_hgvs", "heavy_vehicles")
# Older column names of the classes, in class order.
CLASS_TOTAL_NAMES = (
    "pedal_cycle_total", "two_wheeled_total", "car_and_taxi_total", "bus_and_coach_total",
    "light_goods_total", "hgv2_total", "hgv3_total", "hgv4_total", "hgv34_total", "hgv5_total", "hgv6_total",
)


def _first_present(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def _whole(name: str):
    """Numeric text or number to BIGINT, fractions cut, anything else 0."""
    return F.coalesce(F.col(name).try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def _real(name: str):
    return F.coalesce(F.nanvl(F.col(name).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def normalise_gold(gold: DataFrame, *, backfill: bool = True) -> DataFrame:
    """Canonical names and types. Which column feeds a measure is decided per frame.

    ``backfill`` recomputes the density when no row of the frame carries one; rows that
    this package's own roll-ups wrote never need it.
    """
    cols: dict = {}
    ts = _first_present(gold, TIME_FIELDS)
    if ts is not None:
        is_text = isinstance(gold.schema[ts].dataType, T.StringType)
        cols["event_timestamp"] = parse_ts(F.col(ts)) if is_text else F.col(ts).try_cast("timestamp")
    elif "batch_timestamp" in gold.columns:
        cols["event_timestamp"] = F.timestamp_seconds(F.col("batch_timestamp").try_cast("bigint"))
    else:
        cols["event_timestamp"] = F.current_timestamp()
    if "region_name" not in gold.columns:
        cols["region_name"] = F.lit("Unknown")

    total = _first_present(gold, TOTAL_NAMES)
    cols["total_vehicles"] = _whole(total) if total else F.lit(0).cast("bigint")
    for name in ("total_link_length_km", "link_length_kilometers"):
        if name in gold.columns:
            cols[name] = _real(name)
    density = _first_present(gold, DENSITY_NAMES)
    cols["vehicles_per_km"] = _real(density) if density else F.lit(0.0)
    heavy = _first_present(gold, HEAVY_NAMES)
    axles = [c for c in gold.columns if "heavy_goods_vehicle_" in c]
    cols["heavy_vehicles"] = (
        _whole(heavy) if heavy else sum((_whole(c) for c in axles), F.lit(0).cast("bigint"))
    )
    for field, older, current in zip(CLASS_FIELDS, CLASS_TOTAL_NAMES, CLASS_GOLD):
        # The gold name wins over the older one when both are there.
        source = current if current in gold.columns else older if older in gold.columns else None
        if source:
            cols[field] = _whole(source)
    cols["role"] = F.coalesce("role", F.lit("primary")) if "role" in gold.columns else F.lit("primary")

    records = gold.withColumns(cols).drop(*[c for c in CLASS_GOLD if c in gold.columns])
    return backfill_density(records) if backfill else records


def backfill_density(records: DataFrame) -> DataFrame:
    """Density from totals and lengths, only if the whole frame has none."""
    if "total_link_length_km" in records.columns:
        computed = ratio_or_zero(F.col("total_vehicles"), F.col("total_link_length_km"))
    elif "link_length_kilometers" in records.columns:
        computed = ratio_or_zero(F.col("total_vehicles"), F.col("link_length_kilometers"))
    elif "avg_vehicles" in records.columns:
        computed = _real("avg_vehicles")
    else:
        return records
    known = records.agg(F.sum(F.abs("vehicles_per_km")).alias("s")).select(
        F.coalesce("s", F.lit(0.0)).alias("s")
    ).scalar()
    return records.withColumn(
        "vehicles_per_km", F.when(known == 0, computed).otherwise(F.col("vehicles_per_km"))
    )


def unpivot_classes(df: DataFrame, ids: Sequence[str], names: str = "profile") -> DataFrame:
    """The class columns of ``df`` as (class, count) rows.

    ``names`` picks the labels: ``event`` fields, ``gold`` columns or ``profile`` keys.
    """
    label = {"event": 0, "gold": 1, "profile": 2}[names]
    present = {}
    for triple in VEHICLE_CLASSES:
        source = _first_present(df, triple)
        if source:
            present[triple[label]] = F.col(source).cast("bigint")
    return unpivot(df, ids, present, "vehicle_class", "count")
