"""Statistical profiles per count point, road and region, from prepared counts.

Input of every function: ``prepare_counts`` output with an order column
(``record_ord`` unless named) that says which row came first. Results are long
tables keyed by name or id.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.functions.aggregates import first_values, shares, unpivot
from roadpulse.functions.parsing import safe_float
from roadpulse.functions.text import known_text, slugify, strip
from roadpulse.schemas import LENGTH_FIELDS, LOCATION_FIELDS, VEHICLE_CLASSES

ORDER = "record_ord"
MIN_OBSERVATIONS = 50
TOTAL = "all_motor_vehicle_count"

# Statistic name -> (source column, smallest standard deviation of a road profile).
ROAD_STATS = {
    "latitude": ("latitude", 0.001),
    "longitude": ("longitude", 0.001),
    "easting": ("british_national_grid_easting", 1.0),
    "northing": ("british_national_grid_northing", 1.0),
    "kilometers": ("link_length_kilometers", 0.001),
    "miles": ("link_length_miles", 0.001),
}


def road_id(name: Column) -> Column:
    return F.concat(F.lit("road:"), slugify(name, unicode=True))


def region_id(name: Column) -> Column:
    return F.concat(F.lit("region:"), slugify(name, unicode=True))


# --- count points ---------------------------------------------------------------------


def segment_catalogue(counts: DataFrame, order: str = ORDER) -> DataFrame:
    """One row per count point: descriptors, mean location, directions, dates, totals."""
    numbers = LOCATION_FIELDS + LENGTH_FIELDS
    return described_segments(counts, order, {
        **{f"{n}_sum": F.sum(n) for n in numbers}, **{f"{n}_count": F.count(n) for n in numbers}, "_rows": F.count(F.lit(1))})


def described_segments(counts: DataFrame, order: str, measures: dict[str, Column]) -> DataFrame:
    """The catalogue from counts or their cube: ``measures`` are the sums, counts and rows of either."""
    counts = counts.withColumn("count_point_identifier", known_text(F.col("count_point_identifier")))
    counts = counts.where(F.col("count_point_identifier").isNotNull())
    texts = (
        "region_name", "local_authority_name", "road_name", "road_type",
        "start_junction_road_name", "end_junction_road_name",
    )
    # Cleaned in a projection of their own, so that each text is trimmed once per row.
    numbers = LOCATION_FIELDS + LENGTH_FIELDS
    cleaned = counts.withColumns({**{n: known_text(F.col(n)) for n in texts}, "_direction": known_text(F.col("travel_direction"))})
    # One pass: texts and measures meet in one aggregate.
    described = first_values(
        cleaned, ["count_point_identifier"], {n: F.col(n) for n in (*texts, "_direction")}, order,
        measures={**measures, "_from": F.min("observation_date"), "_to": F.max("observation_date"), "_total": F.sum(TOTAL)},
        extra={
            "_directions": F.array_sort(F.collect_set("_direction")),
            **{f"_{n}": F.sum(f"{n}_sum") / F.nullif(F.sum(f"{n}_count"), F.lit(0)) for n in numbers},
            "observation_start_date": F.date_format(F.min("_from"), "yyyy-MM-dd"),
            "observation_end_date": F.date_format(F.max("_to"), "yyyy-MM-dd"),
            "total_observations": F.sum("_rows"), "all_motor_vehicle_total": F.sum("_total"),
        },
    ).withColumnsRenamed({f"_{n}": n for n in numbers})
    return described.select(
        F.concat(F.lit("segment:"), "count_point_identifier").alias("segment_id"),
        "count_point_identifier",
        *texts,
        *LOCATION_FIELDS, *LENGTH_FIELDS,
        F.nullif(F.array_join("_directions", ";"), F.lit("")).alias("available_directions"),
        "observation_start_date", "observation_end_date", "total_observations", "all_motor_vehicle_total",
    )


# --- roads ----------------------------------------------------------------------------


# Column of a road profile -> column of the counts whose first known text it takes.
DESCRIPTORS = {
    "road_type": "road_type", "region_name": "region_name", "local_authority_name": "local_authority_name",
    "start_junction": "start_junction_road_name", "end_junction": "end_junction_road_name",
}


def road_base_stats(counts: DataFrame, order: str = ORDER, *, extra: Sequence[Column] | None = None) -> DataFrame:
    """Per road: rows, distinct days, first known descriptors, mean and population deviation."""
    present = {n: s for n, (s, _) in ROAD_STATS.items() if s in counts.columns}
    measured = counts.groupBy("road_name").agg(
        F.count(F.lit(1)).alias("observation_count"),
        F.count_distinct("observation_date").alias("days_observed"),
        *[F.avg(s).alias(f"{n}_mean") for n, s in present.items()],
        *[F.coalesce(F.stddev_pop(s), F.lit(0.0)).alias(f"{n}_std") for n, s in present.items()],
        *(extra or []),
    )
    described = first_values(counts, ["road_name"], {k: F.col(v) for k, v in DESCRIPTORS.items()}, order)
    return measured.join(described, "road_name", "left")


def road_direction_mix(counts: DataFrame) -> DataFrame:
    by_direction = counts.groupBy("road_name", F.col("direction_filled").alias("key")).agg(
        F.sum(TOTAL).alias("total")
    )
    # The share is of the road's whole total, so compute that before dropping rows.
    totals = by_direction.groupBy("road_name").agg(F.sum("total").alias("road_total"))
    return (
        by_direction.join(totals, "road_name")
        .where((F.col("road_total") > 0) & (F.col("total") > 0))
        .select(
            "road_name",
            F.coalesce(F.nullif("key", F.lit("")), F.lit("Unknown")).alias("key"),
            (F.col("total") / F.col("road_total")).alias("weight"),
        )
    )


def _hour_profile(counts: DataFrame, by: str) -> DataFrame:
    """Hourly totals per day first, then their mean and deviation per minute."""
    daily = counts.groupBy(by, "observation_date", "hour").agg(F.sum(TOTAL).alias("total"))
    return daily.groupBy(by, "hour").agg(
        (F.avg("total") / 60).alias("mean_per_minute"),
        (F.coalesce(F.stddev_pop("total"), F.lit(0.0)) / 60).alias("std_per_minute"),
        F.count("total").alias("observations"),
    )


def road_hour_profile(counts: DataFrame) -> DataFrame:
    return _hour_profile(counts, "road_name")


def road_baseline(hours: DataFrame) -> DataFrame:
    """Mean of the hourly means: every hour weighs the same."""
    return hours.groupBy("road_name").agg(F.avg("mean_per_minute").alias("baseline_rate_per_minute"))


def _vehicle_mix(counts: DataFrame, by: str, *, positive_whole: bool) -> DataFrame:
    """Class shares. All classes sit in one row per group, so the whole needs no second pass."""
    present = [(s, key) for s, _, key in VEHICLE_CLASSES if s in counts.columns]
    sums = counts.groupBy(by).agg(*[F.coalesce(F.sum(s), F.lit(0.0)).alias(key) for s, key in present])
    parts = [F.greatest(F.col(k), F.lit(0.0)) if positive_whole else F.col(k) for _, k in present]
    whole = sums.withColumn("_whole", reduce(add, parts)).where(F.col("_whole") > 0)
    long = unpivot(whole, [by, "_whole"], {k: F.col(k) for _, k in present}, "key", "value")
    return long.where(F.col("value") > 0).select(by, "key", (F.col("value") / F.col("_whole")).alias("weight"))


def road_vehicle_mix(counts: DataFrame) -> DataFrame:
    return _vehicle_mix(counts, "road_name", positive_whole=False)


def road_profile(counts: DataFrame, *, min_observations: int = MIN_OBSERVATIONS, order: str = ORDER) -> DataFrame:
    """One row per road id of the roads with enough rows, hours and a vehicle mix (the others are
    left out; ``min_observations=1`` keeps every road that has a mix). Of two names that share an
    id the later one wins; the road index lists both."""
    return one_per_id(profiled_roads(counts, min_observations=min_observations, order=order))


def profiled_roads(
    counts: DataFrame, *, min_observations: int = MIN_OBSERVATIONS, order: str = ORDER, base: DataFrame | None = None
) -> DataFrame:
    """One row per road name. Every input is an aggregate by road name, so the joins reuse one
    partitioning. ``base`` are the base statistics with ``all_classes`` where they are known already."""
    if base is None:
        classes = [F.coalesce(s, F.lit(0.0)) for s, _, _ in VEHICLE_CLASSES if s in counts.columns]
        base = road_base_stats(counts, order, extra=[F.sum(reduce(add, classes, F.lit(0.0))).alias("all_classes")])
    base = base.where((F.col("observation_count") >= min_observations) & (F.col("all_classes") > 0))
    rows = base.join(road_baseline(road_hour_profile(counts)), "road_name")
    stats = []
    for n, (_, least) in ROAD_STATS.items():
        if f"{n}_mean" in base.columns:
            stats.append(F.coalesce(f"{n}_mean", F.lit(0.0)).alias(f"{n}_mean"))
            stats.append(F.coalesce(F.nullif(f"{n}_std", F.lit(0.0)), F.lit(least)).alias(f"{n}_std"))
    row = rows.select(
        road_id(F.col("road_name")).alias("road_id"), "road_name", "region_name",
        "local_authority_name", "road_type", "start_junction", "end_junction", *stats,
        "baseline_rate_per_minute", "observation_count", "days_observed",
    )
    return row


def one_per_id(named: DataFrame) -> DataFrame:
    return _last_by_id(named, "road_id", "road_name")


def _last_by_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("r")).select(key, "r.*")


def road_index(named: DataFrame) -> DataFrame:
    """Every profiled road name (``profiled_roads``), also where two share an id."""
    return named.select(
        F.col("road_id").alias("id"), "road_name", "region_name", "local_authority_name",
        "baseline_rate_per_minute",
    )


def by_road_id(roads: DataFrame, table: DataFrame) -> DataFrame:
    """A road-name table for the profiled roads, keyed by ``road_id``."""
    names = roads.select("road_id", "road_name")
    return names.join(table, "road_name").drop("road_name")


# --- regions --------------------------------------------------------------------------


def region_hour_profile(counts: DataFrame) -> DataFrame:
    return _hour_profile(counts, "region_filled").withColumnRenamed("region_filled", "region_name")


def assigned_region(roads: DataFrame) -> DataFrame:
    """Profiled roads with the region they count for: the first one seen."""
    region = F.coalesce(F.nullif("region_name", F.lit("")), F.lit("Unknown Region"))
    return roads.withColumn("region_name", region)


def region_vehicle_mix(counts: DataFrame, roads: DataFrame) -> DataFrame:
    return _of_profiled_regions(_vehicle_mix(counts, "region_filled", positive_whole=True), roads)


def _region_shares(counts: DataFrame, dim: str) -> DataFrame:
    sums = counts.groupBy("region_filled", F.col(dim).alias("key")).agg(F.sum(TOTAL).alias("total"))
    return shares(sums, ["region_filled"], "total")


def region_direction_mix(counts: DataFrame, roads: DataFrame) -> DataFrame:
    return _of_profiled_regions(_region_shares(counts, "direction_filled"), roads)


def region_authority_mix(counts: DataFrame, roads: DataFrame) -> DataFrame:
    return _of_profiled_regions(_region_shares(counts, "authority_filled"), roads)


def _of_profiled_regions(mix: DataFrame, roads: DataFrame) -> DataFrame:
    regions = assigned_region(roads).select("region_name").distinct()
    return mix.withColumnRenamed("region_filled", "region_name").join(regions, "region_name", "left_semi")


def region_road_share(counts: DataFrame, roads: DataFrame) -> DataFrame:
    """Each assigned road's share of its region's traffic.

    The whole is the traffic of all roads in the region, so the kept shares need not add
    up to one. A region none of whose roads match falls back to baseline shares.
    """
    assigned = assigned_region(roads).select("road_id", "road_name", "region_name", "baseline_rate_per_minute")
    # One row per region and road from here on; the windows run over those, not over counts.
    region = W.partitionBy("region_name")
    sums = counts.groupBy(F.col("region_filled").alias("region_name"), "road_name").agg(F.sum(TOTAL).alias("total"))
    positive = sums.where((F.col("total") > 0) & (F.col("total") < float("inf")))
    traffic = positive.select("region_name", "road_name", (F.col("total") / F.sum("total").over(region)).alias("weight"))
    base = F.col("baseline_rate_per_minute")
    both = assigned.join(traffic, ["region_name", "road_name"], "left").withColumns({
        "_matched": F.count("weight").over(region), "_baselines": F.sum(F.when(base > 0, base)).over(region),
    })
    weight = F.when(F.col("_matched") > 0, F.col("weight")).when(base > 0, base / F.col("_baselines"))
    return both.select("region_name", "road_id", weight.alias("weight")).where(F.col("weight").isNotNull())


def region_profile(counts: DataFrame, roads: DataFrame) -> DataFrame:
    of_roads = assigned_region(roads).groupBy("region_name").agg(
        F.count(F.lit(1)).alias("road_count"),
        F.sum("baseline_rate_per_minute").alias("road_baselines"),
        F.sum("observation_count").alias("observation_count"),
    )
    of_hours = region_hour_profile(counts).groupBy("region_name").agg(
        F.avg("mean_per_minute").alias("hour_baseline")
    )
    days = counts.groupBy(F.col("region_filled").alias("region_name")).agg(
        F.count_distinct("observation_date").alias("days_observed")
    )
    rate = F.coalesce("hour_baseline", "road_baselines")
    return (
        of_roads.join(of_hours, "region_name", "left").join(days, "region_name", "left")
        .select(
            region_id(F.col("region_name")).alias("region_id"), "region_name", "road_count",
            F.when(rate > 0, rate)
            .otherwise(F.greatest("road_baselines", F.lit(0.1))).alias("baseline_rate_per_minute"),
            "observation_count",
            F.coalesce("days_observed", F.lit(0)).alias("days_observed"),
        )
    )


def region_index(regions: DataFrame) -> DataFrame:
    return regions.select(
        F.col("region_id").alias("id"), "region_name", "road_count", "baseline_rate_per_minute"
    )


def list_regions_clean(index: DataFrame) -> DataFrame:
    """A region index of any origin with safe numbers and ids."""
    raw_id = F.coalesce(strip(F.col("id")), F.lit(""))
    name = strip(F.coalesce(F.nullif("region_name", F.lit("")), F.nullif(raw_id, F.lit("")), F.lit("Unknown Region")))
    zero = F.lit(0).cast("bigint")
    return index.select(
        F.coalesce(F.nullif(raw_id, F.lit("")), region_id(name)).alias("region_id"),
        name.alias("region_name"),
        F.greatest(safe_float(F.col("baseline_rate_per_minute")), F.lit(0.0)).alias("baseline_rate"),
        F.greatest(F.coalesce(F.col("road_count").try_cast("bigint"), zero), zero).alias("road_count"),
    )


def profile_meta(
    roads: DataFrame, regions: DataFrame, segments: DataFrame, *,
    min_observations: int = MIN_OBSERVATIONS, source: str = "spark",
) -> DataFrame:
    """Counts of one profile build, a single row."""
    tagged = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(n).alias("kind")) for n, df in (("road", roads), ("region", regions), ("segment", segments))],
    )
    count = lambda kind: F.count_if(F.col("kind") == kind)
    return tagged.agg(
        count("road").alias("road_count"), count("region").alias("region_count"),
        count("segment").alias("segment_count"),
    ).select(
        F.lit(source).alias("source"), F.lit(min_observations).alias("min_observations"), "*"
    )


def region_slugs(regions: DataFrame) -> DataFrame:
    """File-safe region names; regions that share a slug get ``-1``, ``-2`` … in id order."""
    slug = slugify(F.coalesce(F.nullif("region_name", F.lit("")), "region_id"), unicode=True)
    nth = F.row_number().over(W.partitionBy("_slug").orderBy("region_id", "region_name")) - 1
    return regions.withColumn("_slug", slug).withColumn("_nth", nth).withColumn(
        "region_slug",
        F.when(F.col("_nth") > 0, F.concat("_slug", F.lit("-"), "_nth")).otherwise(F.col("_slug")),
    ).drop("_slug", "_nth")


def region_slices(regions: DataFrame, roads: DataFrame) -> DataFrame:
    """The roads of every region slice with the slice's name and road count."""
    slices = region_slugs(regions).select("region_slug", "region_id", "region_name", F.col("road_count").alias("slice_road_count"))
    return slices.join(assigned_region(roads), "region_name").select(
        "region_slug", "region_id", "region_name", "slice_road_count", "road_id", "road_name",
        "local_authority_name", "baseline_rate_per_minute", "observation_count",
    )


def slice_roads(roads: DataFrame, copies: DataFrame) -> DataFrame:
    """The roads of every slice: ``copies`` (region_id and the columns of ``roads``) names them. A road
    takes its row of ``roads``; one that is not there keeps the region's copy."""
    values = [c for c in roads.columns if c != "road_id"]
    known = roads.select("road_id", F.struct(*values).alias("_known"))
    own = copies.select("region_id", "road_id", F.struct(*values).alias("_own"))
    return own.join(known, "road_id", "left").select(
        "region_id", "road_id", F.coalesce("_known", "_own").alias("_v")
    ).select("region_id", "road_id", "_v.*")


def slice_index(index: DataFrame, members: DataFrame) -> DataFrame:
    """The road index rows of every slice; ``members`` holds (region_id, road_id). Of rows that share
    an id, that of the last name; ids without a row have none."""
    row = F.struct(*index.columns)
    last = index.where(strip(F.col("id")) != "").groupBy(strip(F.col("id")).alias("road_id")).agg(F.max_by(row, "road_name").alias("_row"))
    return members.select("region_id", "road_id").distinct().join(last, "road_id").select("region_id", "_row.*")


def slice_meta(meta: DataFrame, regions: DataFrame, members: DataFrame) -> DataFrame:
    """The meta row of every slice: that of the build (one row), with the slice's own counts and names.
    A region without an id or without roads has no slice."""
    counts = members.groupBy("region_id").agg(F.count_distinct("road_id").alias("road_count"))
    base = meta.select(F.struct(*[c for c in meta.columns if c not in ("region_count", "road_count")]).alias("m")).scalar()
    return regions.where(strip(F.col("region_id")) != "").select("region_id", "region_name").join(counts, "region_id").select(
        "region_id", base.alias("m"), F.lit(1).alias("region_count"), "road_count",
        F.col("region_id").alias("slice_region_id"),
        strip(F.coalesce(F.nullif("region_name", F.lit("")), "region_id")).alias("slice_region_name"),
    ).select("region_id", "m.*", "region_count", "road_count", "slice_region_id", "slice_region_name")


# --- reading profiles back ------------------------------------------------------------


def complete_hour_profile(hours: DataFrame, baselines: DataFrame, key: str = "road_id") -> DataFrame:
    """Hour rows fit for use: hours wrap at 24, gaps take the baseline, and a key
    without any hour gets 24 flat rows."""
    base = F.col("baseline_rate_per_minute")
    spread = F.greatest(base * 0.1, F.lit(0.01))
    wrapped = hours.groupBy(key, F.pmod("hour", F.lit(24)).alias("h")).agg(
        F.max_by(F.struct("mean_per_minute", "std_per_minute", "observations"), "hour").alias("v")
    )
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    return (
        baselines.select(key, base)
        .join(wrapped, key, "left")
        # Only keys without hours fan out, to the 24 hours of a day.
        .withColumn("hour", F.explode(
            F.when(F.col("h").isNotNull(), F.array("h")).otherwise(F.sequence(F.lit(0), F.lit(23)))
        ))
        .select(
            key, "hour",
            F.coalesce(finite(F.col("v.mean_per_minute")), base).alias("mean_per_minute"),
            F.abs(F.coalesce(finite(F.col("v.std_per_minute")), spread)).alias("std_per_minute"),
            F.coalesce("v.observations", F.lit(0)).alias("observations"),
        )
    )


# Fixed values: (column, default, floor) of a road profile that is read back.
_ROAD_LIMITS = (
    ("latitude_mean", 0.0, None), ("latitude_std", 0.0005, 0.0005),
    ("longitude_mean", 0.0, None), ("longitude_std", 0.0005, 0.0005),
    ("easting_mean", 0.0, None), ("easting_std", 1.0, 1.0),
    ("northing_mean", 0.0, None), ("northing_std", 1.0, 1.0),
    ("kilometers_mean", 1.0, 0.05), ("kilometers_std", 0.05, 0.01),
    ("miles_mean", 0.62, 0.03), ("miles_std", 0.05, 0.01),
    ("baseline_rate_per_minute", 0.5, None),
)


def validated_profile(roads: DataFrame) -> DataFrame:
    """Road profiles with defaults for missing numbers and lower limits applied."""
    limited = {}
    for name, default, floor in _ROAD_LIMITS:
        value = safe_float(F.col(name), default, finite=True)
        limited[name] = value if floor is None else F.greatest(value, F.lit(floor))
    text = lambda c, default: F.coalesce(F.nullif(F.col(c), F.lit("")), default)
    return roads.withColumns({
        **limited,
        "road_name": text("road_name", F.col("road_id")),
        "region_name": text("region_name", F.lit("Unknown")),
        "local_authority_name": text("local_authority_name", F.lit("Unknown Authority")),
    })


def validated_region(regions: DataFrame) -> DataFrame:
    rate = safe_float(F.col("baseline_rate_per_minute"), 1.0, finite=True)
    return regions.withColumn("baseline_rate_per_minute", F.greatest(rate, F.lit(0.05)))


# The only share of a road whose mix is empty.
DEFAULT_MIX = {"direction": "Unknown", "vehicle": "car_and_taxi"}


def validated_mix(mix: DataFrame, keys: DataFrame, by: str, default: str | None) -> DataFrame:
    """Renormalised weights; keys left without any get ``default`` with weight 1."""
    kept = shares(mix.select(by, "key", "weight"), [by], "weight")
    if default is None:
        return kept
    bare = keys.select(by).distinct().join(kept.select(by).distinct(), by, "left_anti")
    return kept.unionByName(bare.select(by, F.lit(default).alias("key"), F.lit(1.0).alias("weight")))
