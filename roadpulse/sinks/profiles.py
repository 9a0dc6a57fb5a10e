"""Profile tables on disk, and the region slices exported from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.profiles import assigned_region, region_slugs, slice_index, slice_meta, slice_roads

TABLES = (
    "segment", "road_name", "road_index", "road_profile", "road_hour", "road_mix", "region_profile", "region_hour", "region_mix", "meta",
)


def read_profile(spark: SparkSession, root: str, table: str) -> DataFrame:
    if table not in TABLES:
        raise ValueError(f"unknown profile table: {table}")
    return spark.read.parquet(f"{root}/{table}")


def _map_of(table: DataFrame, by: str, key: str, value, name: str) -> DataFrame:
    """A MAP per group, for the export only: at most 24 hours, the classes or the directions."""
    return table.groupBy(by).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v"))))).alias(name)
    )


def road_documents(spark: SparkSession, root: str) -> DataFrame:
    """One nested row per road."""
    roads, hours, mix = (read_profile(spark, root, t) for t in ("road_profile", "road_hour", "road_mix"))
    hour = F.struct("mean_per_minute", "std_per_minute", "observations")
    of = lambda dim: mix.where(F.col("dim") == dim)
    nested = (
        roads.join(_map_of(hours, "road_id", "hour", hour, "hourly_profile"), "road_id", "left")
        .join(_map_of(of("direction"), "road_id", "key", F.col("weight"), "direction_distribution"), "road_id", "left")
        .join(_map_of(of("vehicle"), "road_id", "key", F.col("weight"), "vehicle_distribution"), "road_id", "left")
    )
    stats = lambda *names: F.struct(*[f"{n}_{s}" for n in names for s in ("mean", "std")])
    return nested.select(
        "road_id", "road_name", "region_name", "local_authority_name", "road_type", "start_junction",
        "end_junction", stats("latitude", "longitude", "easting", "northing").alias("location"),
        stats("kilometers", "miles").alias("link_length"), "hourly_profile", "direction_distribution",
        "vehicle_distribution", "baseline_rate_per_minute", "observation_count", "days_observed",
    )


def export_profiles(spark: SparkSession, root: str, target: str, *, copies: DataFrame | None = None) -> None:
    """Per-region slices as JSON lines, one folder per region that has roads.

    ``regions`` has the region rows, ``meta`` the meta row of each slice, ``roads`` the nested road
    rows, ``index`` their rows of the road index, ``shares`` the authority and road weights in long
    form: a region may have any number of those, so they are never gathered into one row.
    ``copies`` (region_id and the columns of ``road_documents``) are roads as the regions hold them,
    also such as the profiles do not know; without them, a region has the roads assigned to it.
    """
    roads = road_documents(spark, root)
    every = read_profile(spark, root, "region_profile")
    if copies is None:
        inside = assigned_region(roads).join(every.select("region_id", "region_name"), "region_name")
    else:
        inside = slice_roads(roads, copies)
    members = inside.select("region_id", "road_id")
    meta = slice_meta(read_profile(spark, root, "meta"), every, members)
    regions = region_slugs(every.join(meta.select("region_id"), "region_id", "left_semi"))
    slugs = regions.select("region_slug", "region_id")

    def store(name: str, rows: DataFrame) -> None:
        rows.hint("rebalance", F.col("region_slug")).write.mode("overwrite").partitionBy("region_slug").json(f"{target}/{name}")

    hour = F.struct("mean_per_minute", "std_per_minute", "observations")
    hours = _map_of(read_profile(spark, root, "region_hour"), "region_name", "hour", hour, "hourly_profile")
    store("regions", regions.join(hours, "region_name", "left").withColumn("region_count", F.lit(1)))
    store("meta", meta.join(slugs, "region_id").drop("region_id"))
    store("roads", inside.join(slugs, "region_id"))
    store("index", slice_index(read_profile(spark, root, "road_index"), members).join(slugs, "region_id").drop("region_id"))
    names = regions.select("region_slug", "region_name")
    store("shares", read_profile(spark, root, "region_mix").join(names, "region_name"))
