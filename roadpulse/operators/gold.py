"""Per-minute roll-ups of normalised events by region, authority and road.

Every roll-up starts from one partial aggregate per (region, authority, road,
minute), combined on the map side, so a hot region or road is reduced before it
is shuffled. A road's length counts once per group: the maximum per road first,
the sum over roads second.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.measures import ratio_or_zero
from roadpulse.schemas import CLASS_GOLD, GOLD, GOLD_ADDITIVE

_MEASURES = ("total_vehicles", "heavy_vehicles") + CLASS_GOLD
_DESCRIPTORS = ("road_name", "road_type", "start_junction", "end_junction")
# Descriptor texts that give way to a later, known value.
_PLACEHOLDERS = {
    "road_name": ("", "Unknown road"),
    "start_junction": ("", "Unknown start"),
    "end_junction": ("", "Unknown end"),
}


def _event_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in _MEASURES] + [F.count(F.lit(1)).alias("event_count")]


def _partial_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in GOLD_ADDITIVE]


def _positive_length() -> Column:
    return F.max(F.when(F.col("link_length_km") > 0, F.col("link_length_km"))).alias("length_km")


def _ratios(length: Column) -> list[Column]:
    return [
        (F.col("total_vehicles") / F.greatest(F.col("event_count"), F.lit(1))).alias("avg_vehicles"),
        length.alias("total_link_length_km"),
        ratio_or_zero(F.col("total_vehicles"), length).alias("vehicles_per_km"),
    ]


def _finish(rolled: DataFrame, role: Column, batch: Sequence[str]) -> DataFrame:
    """The gold column set, in its fixed order."""
    have = set(rolled.columns)
    length = F.coalesce("length_km", F.lit(0.0))
    road_length = F.when(role == "road", length)
    computed = {
        "role": role,
        "link_length_kilometers": road_length,
        "batch_id": F.col("batch_id") if batch else F.lit(None).cast("bigint"),
        "batch_timestamp": F.unix_timestamp("minute"),
        "event_timestamp": F.col("minute"),
        "writer_failover_active": F.lit(False),
        "start_junction_name": F.col("start_junction") if "start_junction" in have else F.lit(None).cast("string"),
        "end_junction_name": F.col("end_junction") if "end_junction" in have else F.lit(None).cast("string"),
        "road_id": F.col("road_key") if "road_key" in have else F.lit(None).cast("string"),
    }
    ratios = dict(zip(("avg_vehicles", "total_link_length_km", "vehicles_per_km"), _ratios(length)))
    out = []
    for f in GOLD.fields:
        if f.name in computed:
            out.append(computed[f.name].alias(f.name))
        elif f.name in ratios:
            out.append(ratios[f.name])
        elif f.name in have:
            out.append(F.col(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return rolled.select(*out)


def _rollup(events: DataFrame, keys: Sequence[str], batch: Sequence[str]) -> DataFrame:
    by_road = events.groupBy(*keys, "road_key", "minute", *batch).agg(*_event_sums(), _positive_length())
    return by_road.groupBy(*keys, "minute", *batch).agg(
        *_partial_sums(), F.sum("length_km").alias("length_km")
    )


def gold_region(events: DataFrame, *, batch: Sequence[str] = ()) -> DataFrame:
    return _finish(_rollup(events, ["region_name"], batch), F.lit("primary"), batch)


def gold_authority(events: DataFrame, *, batch: Sequence[str] = ()) -> DataFrame:
    rolled = _rollup(events, ["region_name", "local_authority_name"], batch)
    return _finish(rolled, F.lit("authority"), batch)


def distinct_link_length(events: DataFrame, keys: Sequence[str] = ("region_name",)) -> DataFrame:
    """Summed length per (keys, minute), each road counted once with its maximum."""
    by_road = events.groupBy(*keys, "road_key", "minute").agg(_positive_length())
    return by_road.groupBy(*keys, "minute").agg(
        F.coalesce(F.sum("length_km"), F.lit(0.0)).alias("total_link_length_km"),
        F.count("length_km").alias("roads_measured"),
    )


def _road_partials(events: DataFrame, batch: Sequence[str]) -> DataFrame:
    """One row per road, minute and distinct descriptor set.

    The descriptors are grouping keys here and the arrival bounds are BIGINT, so this
    first, big aggregate stays a hash aggregate with map-side combine.
    """
    return events.groupBy(
        "region_name", "local_authority_name", "road_key", "minute", *batch, *_DESCRIPTORS
    ).agg(
        *_event_sums(),
        _positive_length(),
        F.min("arrival").alias("first_arrival"),
        F.max("arrival").alias("last_arrival"),
    )


def _first_known(name: str) -> Column:
    """First value in arrival order that is no placeholder, else the last value."""
    value = F.col(name)
    first = F.struct("first_arrival", *_DESCRIPTORS)
    last = F.struct("last_arrival", *_DESCRIPTORS)
    if name not in _PLACEHOLDERS:
        return F.min_by(value, first).alias(name)
    known = ~value.isin(*_PLACEHOLDERS[name])
    return F.coalesce(F.min_by(value, F.when(known, first)), F.max_by(value, last)).alias(name)


def _roads(partials: DataFrame, batch: Sequence[str]) -> DataFrame:
    return partials.groupBy(
        "region_name", "local_authority_name", "road_key", "minute", *batch
    ).agg(
        *_partial_sums(),
        F.max("length_km").alias("length_km"),
        *[_first_known(n) for n in _DESCRIPTORS],
    )


def gold_road(events: DataFrame, *, batch: Sequence[str] = ()) -> DataFrame:
    return _finish(_roads(_road_partials(events, batch), batch), F.lit("road"), batch)


def first_known_descriptor(events: DataFrame) -> DataFrame:
    """The descriptors of every (region, authority, road, minute)."""
    keys = ["region_name", "local_authority_name", "road_key", "minute"]
    seen = events.groupBy(*keys, *_DESCRIPTORS).agg(
        F.min("arrival").alias("first_arrival"), F.max("arrival").alias("last_arrival")
    )
    return seen.groupBy(*keys).agg(*[_first_known(n) for n in _DESCRIPTORS])


def gold_all(events: DataFrame, *, batch: Sequence[str] = ()) -> DataFrame:
    """Region, authority and road rows in one pass over the events.

    Three shuffles, each of far fewer rows: the map-side-combined partials; those by (region,
    road, minute), which serves all groupings that still hold the road and spreads one region
    and minute over all tasks; and the region and authority sums, combined before they move.
    """
    roads = _roads(
        _road_partials(events, batch).repartition("region_name", "road_key", "minute"), batch
    )
    role = F.col("role")
    leveled = roads.withColumn(
        "role", F.explode(F.array(F.lit("primary"), F.lit("authority"), F.lit("road")))
    ).withColumns({
        "local_authority_name": F.when(role != "primary", F.col("local_authority_name")),
        **{n: F.when(role == "road", F.col(n)) for n in _DESCRIPTORS},
    })
    keys = ["role", "region_name", "local_authority_name", "minute", *batch]
    # A road that crosses authorities has one length at region level: its maximum.
    per_road = leveled.groupBy(*keys, "road_key", *_DESCRIPTORS).agg(
        *_partial_sums(), F.max("length_km").alias("length_km")
    )
    rolled = (
        per_road.withColumn("road_key", F.when(role == "road", F.col("road_key")))
        .groupBy(*keys, "road_key", *_DESCRIPTORS)
        .agg(*_partial_sums(), F.sum("length_km").alias("length_km"))
    )
    return _finish(rolled, role, batch)


def merge_gold_partials(gold: DataFrame) -> DataFrame:
    """Compact per-batch partial rows to one row per key and minute.

    Sums add up. Lengths do not: region and authority rows carry no road keys, so
    their merged length comes from the road rows of the same minute.
    """
    g = gold.withColumnsRenamed({
        "event_timestamp": "minute", "road_id": "road_key", "link_length_kilometers": "length_km",
        "start_junction_name": "start_junction", "end_junction_name": "end_junction",
    }).withColumn("length_km", F.when(F.col("length_km") > 0, F.col("length_km")))
    keys = ["role", "region_name", "local_authority_name", "road_key", "minute"]
    g = g.select(*keys, "batch_id", *GOLD_ADDITIVE, *_DESCRIPTORS, "length_km")
    role, road = F.col("role"), F.col("role") == "road"
    # Each row is read once: road rows also speak for the lengths of the two levels above them,
    # where they bring a length and nothing else.
    levels = F.when(road, F.array(F.lit("primary"), F.lit("authority"), role)).otherwise(F.array(role))
    g = g.withColumn("level", F.explode(levels)).withColumn("own", role.eqNullSafe(F.col("level")))
    partials = g.select(
        F.col("level").alias("role"), "region_name",
        F.when(F.col("own") | (F.col("level") != "primary"), F.col("local_authority_name")).alias("local_authority_name"),
        "road_key", "minute", "length_km",
        *[F.when(F.col("own"), F.col(n)).alias(n) for n in ("batch_id", *GOLD_ADDITIVE, *_DESCRIPTORS)],
        F.col("own").cast("int").alias("own"),
    ).groupBy(*keys, *_DESCRIPTORS).agg(  # buffers of fixed width: a hash aggregate with a map-side part
        *_partial_sums(), F.max("length_km").alias("length_km"), F.max("own").alias("own"),
        F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"),
    )
    own = F.col("own") == 1
    first = F.when(own, F.struct("first_batch", *_DESCRIPTORS))
    last = F.when(own, F.struct("last_batch", *_DESCRIPTORS))

    def descriptor(name: str) -> Column:
        value = F.col(name)
        known = first if name not in _PLACEHOLDERS else F.when(~value.isin(*_PLACEHOLDERS[name]), first)
        return F.coalesce(F.min_by(value, known), F.max_by(value, last)).alias(name)

    merged = partials.withColumn("length_of", F.when(road, F.col("road_key"))).groupBy(
        "role", "region_name", "local_authority_name", F.col("length_of").alias("road_key"), "minute"
    ).agg(
        *_partial_sums(), F.max("own").alias("own"),
        # A road's length is its longest; those of different roads add up.
        F.when(road, F.max("length_km")).otherwise(F.sum("length_km")).alias("length_km"),
        *[descriptor(n) for n in _DESCRIPTORS],
    )
    return _finish(merged.where(F.col("own") == 1).drop("own"), role, ())
