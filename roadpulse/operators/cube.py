"""A mergeable cube of counts, and the profile inputs that are read from it.

One row per count point, road, texts, direction, day and hour, with sums, moments and the place of the
first row. A day's rows depend on that day alone, so days can be replaced one by one. The cube has
the columns of prepared counts with summed values, so every profile that only adds up takes it in
their place; those that average or pick texts are here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.aggregates import first_values
from roadpulse.operators.cleaning import fill_dimensions
from roadpulse.operators.profiles import DESCRIPTORS, ORDER, ROAD_STATS, TOTAL, described_segments
from roadpulse.schemas import LENGTH_FIELDS, LOCATION_FIELDS, VEHICLE_CLASSES

KEYS = (
    "count_point_identifier", "road_name", "region_name", "local_authority_name", "road_type",
    "start_junction_road_name", "end_junction_road_name", "travel_direction", "observation_date", "hour",
)
_MEASURED = LOCATION_FIELDS + LENGTH_FIELDS


def count_cube(counts: DataFrame, order: str = ORDER, by: Sequence[str] = ()) -> DataFrame:
    """Prepared counts by ``KEYS`` and ``by``: one hash aggregate with a map-side part, all buffers of fixed width."""
    measured = [n for n in _MEASURED if n in counts.columns]
    classes = [c for c, _, _ in VEHICLE_CLASSES if c in counts.columns]
    moments = []
    for n in measured:
        moments += [
            F.count(n).alias(f"{n}_n"), F.sum(n).alias(f"{n}_sum"), (F.var_pop(n) * F.count(n)).alias(f"{n}_m2"),
            F.min(n).alias(f"{n}_min"), F.max(n).alias(f"{n}_max"),
        ]
    return counts.groupBy(*KEYS, *by).agg(
        F.count(F.lit(1)).alias("rows"), F.min(order).alias(order), F.sum(TOTAL).alias(TOTAL), *[F.sum(c).alias(c) for c in classes], *moments)


def as_counts(cube: DataFrame) -> DataFrame:
    """The cube as prepared counts of which every row stands for ``rows`` of them."""
    return fill_dimensions(cube)


def road_base_stats(cube: DataFrame, order: str = ORDER) -> DataFrame:
    """``profiles.road_base_stats`` with ``all_classes``, from the cube.

    Deviations merge in parallel form: the squares within the rows of the cube, and those of their
    means around the mean of the road, which is joined back. Equal values have exactly none."""
    present = {n: s for n, (s, _) in ROAD_STATS.items() if f"{s}_n" in cube.columns}
    classes = [F.coalesce(c, F.lit(0.0)) for c, _, _ in VEHICLE_CLASSES if c in cube.columns]
    per_road = cube.groupBy("road_name").agg(
        F.sum("rows").alias("observation_count"), F.count_distinct("observation_date").alias("days_observed"),
        F.sum(reduce(add, classes, F.lit(0.0))).alias("all_classes"),
        *[F.sum(f"{s}_n").alias(f"{n}_n") for n, s in present.items()],
        *[(F.sum(f"{s}_sum") / F.nullif(F.sum(f"{s}_n"), F.lit(0))).alias(f"{n}_mean") for n, s in present.items()],
        *[(F.max(f"{s}_max") == F.min(f"{s}_min")).alias(f"{n}_same") for n, s in present.items()],
    )
    means = per_road.select(F.col("road_name").alias("_road"), *[F.col(f"{n}_mean").alias(f"_{n}") for n in present])
    apart = {n: F.col(f"{s}_sum") / F.nullif(F.col(f"{s}_n"), F.lit(0)) - F.col(f"_{n}") for n, s in present.items()}
    squares = cube.join(means, F.col("road_name") == F.col("_road")).groupBy(F.col("road_name").alias("_road")).agg(
        *[F.sum(F.col(f"{s}_m2") + F.col(f"{s}_n") * apart[n] * apart[n]).alias(f"{n}_m2") for n, s in present.items()])
    deviation = {n: F.when(F.col(f"{n}_same"), F.lit(0.0)).otherwise(F.sqrt(F.col(f"{n}_m2") / F.col(f"{n}_n"))) for n in present}
    described = first_values(cube, ["road_name"], {k: F.col(v) for k, v in DESCRIPTORS.items()}, order)
    return per_road.join(squares, F.col("road_name") == F.col("_road"), "left").select(
        "road_name", "observation_count", "days_observed", "all_classes", *[f"{n}_mean" for n in present],
        *[F.coalesce(deviation[n], F.lit(0.0)).alias(f"{n}_std") for n in present],
    ).join(described, "road_name", "left")


def segment_catalogue(cube: DataFrame, order: str = ORDER) -> DataFrame:
    """``profiles.segment_catalogue`` from the cube."""
    return described_segments(cube, order, {
        **{f"{n}_sum": F.sum(f"{n}_sum") for n in _MEASURED}, **{f"{n}_count": F.sum(f"{n}_n") for n in _MEASURED}, "_rows": F.sum("rows")})
