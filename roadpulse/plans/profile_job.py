"""Batch job: raw counts to clean counts to profile tables."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import cleaning, cube, profiles
from roadpulse.sinks.profiles import read_profile
from roadpulse.sinks.writers import write_clean_counts
from roadpulse.sources.counts import read_clean_counts, read_raw_counts
from roadpulse.sources.tables import list_files, table_or_empty
from roadpulse.streaming.maintenance import Files

ORDER = "record_ord"
_ROW_BITS = 33
PARTS = "part string, mark long, version long, run long"


def clean_job(spark: SparkSession, source: str, target: str, *, folders: str = "yyyy-MM-dd") -> None:
    """Clean a raw CSV and store it as parquet with an order column, a folder (``dt=``) per day or per
    whatever the date pattern ``folders`` tells apart."""
    raw = read_raw_counts(spark, source)
    clean = cleaning.clean_counts(with_file_order(raw))
    write_clean_counts(clean.withColumn("dt", F.date_format("observation_date", folders)), target, by=["dt"])


def with_file_order(rows: DataFrame) -> DataFrame:
    """Rows read from files with their position as one BIGINT: the file by name, the block in it
    (blocks start at least 1 MiB apart), the row in the block. Tasks pack blocks by size, so a
    plain running number would not be the order of the file."""
    # Spark writes the root of a path with one slash here and with three there.
    files = sorted(re.sub("^file:/+", "/", f) for f in rows.inputFiles())
    path = F.regexp_replace("_metadata.file_path", "^file:/+", "/")
    place = F.array_position(F.array(*[F.lit(f) for f in files]), path)
    number = F.when(place > 0, place - 1).otherwise(F.raise_error(F.concat(F.lit("not an input file: "), path)).cast("bigint"))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.withColumn(ORDER, _block_number(number, F.col("_metadata.file_block_start"), len(files)).bitwiseOR(row))


def _block_number(number: Column, start: Column, files: int) -> Column:
    """File number and block above the bits of the row. ``files`` take the bits they need and blocks
    the rest of the 30, so one file may have 1 PiB and a million may have 1 GiB each; beyond that it raises."""
    block_bits = 63 - _ROW_BITS - max(files - 1, 0).bit_length()
    block = F.shiftright(start, 20)
    fits = number.between(0, files - 1) & (block < F.lit(1 << max(block_bits, 0)))
    wrong = F.raise_error(F.concat(F.lit("no order number for file "), number, F.lit(f" of {files}, block "), block))
    return F.when(fits if block_bits >= 0 else F.lit(False), F.shiftleft(F.shiftleft(number, max(block_bits, 0)).bitwiseOR(block), _ROW_BITS)).otherwise(
        wrong.cast("bigint"))


def update_cube(spark: SparkSession, clean_path: str, root: str) -> list[str]:
    """Bring the cube below ``root`` up to the clean table; returns the names of the parts it read.

    A part is a day's folder (``dt=``) of the clean table, or all of a table without such folders. The
    files of a part tell whether it changed: only new and changed parts are read, once, and written as
    a new version; the list of parts, written last, names the version of each, so a run that stops
    half way changes nothing, and parts that are gone are no longer listed. The driver sees one short
    row per day."""
    day = F.regexp_extract("path", r"/dt=([^/]+)/[^/]*$", 1)
    files = list_files(spark, [clean_path]).where(F.col("path").rlike(r"/[^_./][^/]*\.parquet$"))
    parts = files.groupBy(F.when(day == "", "all").otherwise(F.concat(F.lit("d"), day)).alias("part")).agg(
        F.bit_xor(F.xxhash64("path", "modified", "size")).alias("mark"))
    listed = table_or_empty(spark, f"{root}/cube_parts", PARTS)
    run = listed.agg(F.max("run")).first()[0]
    known = {r.part: (r.mark, r.version) for r in listed.where(F.col("run") == F.lit(run)).collect()} if run is not None else {}
    marks = {r.part: r.mark for r in parts.collect()}
    changed = sorted(p for p, mark in marks.items() if known.get(p, (None,))[0] != mark)
    if not changed and marks.keys() == known.keys():
        return []
    version = 0 if run is None else run + 1
    if changed:
        clean = read_clean_counts(spark, clean_path)
        if ORDER not in clean.columns:
            raise cleaning.MissingColumns(f"{ORDER}: which row comes first is not known")
        if changed != ["all"]:
            folder = F.col("dt").cast("string")
            folder = F.coalesce(folder, F.lit("__HIVE_DEFAULT_PARTITION__"))
            clean = clean.where(folder.isin([p[1:] for p in changed])).withColumn("part", F.concat(F.lit("d"), folder))
        else:
            clean = clean.withColumn("part", F.lit("all"))
        rows = cube.count_cube(cleaning.prepare_counts(clean), ORDER, ["part"])
        rows.hint("rebalance", F.col("part")).write.mode("overwrite").partitionBy("part").parquet(f"{root}/cube/version={version}")
    entries = [(p, mark, version if p in changed else known[p][1]) for p, mark in marks.items()]
    spark.createDataFrame(entries, "part string, mark long, version long").coalesce(1).write.mode("overwrite").parquet(f"{root}/cube_parts/run={version}")
    files_of = Files(spark)
    files_of.remove_numbered(f"{root}/cube", "version=", min(v for _, _, v in entries))
    files_of.remove_numbered(f"{root}/cube_parts", "run=", version)
    return changed


def read_cube(spark: SparkSession, root: str) -> DataFrame:
    """The cube in the version that the newest list names for each part."""
    listed = table_or_empty(spark, f"{root}/cube_parts", PARTS)
    current = listed.where(F.col("run") == listed.agg(F.max("run")).scalar()).select("part", "version")
    return spark.read.parquet(f"{root}/cube").join(current, ["part", "version"], "left_semi").drop("part", "version")


def build_profiles(
    spark: SparkSession, clean_path: str, root: str, *, min_observations: int = profiles.MIN_OBSERVATIONS
) -> None:
    """All profile tables under ``root``.

    The clean counts are read once, and of those only the days that changed since the last build;
    all tables come from the cube of counts, the region tables also from the stored road profiles.
    """
    update_cube(spark, clean_path, root)
    counted = read_cube(spark, root)
    counts = cube.as_counts(counted)

    def store(table: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{root}/{table}")

    def long(**mixes: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, [df.withColumn("dim", F.lit(d)) for d, df in mixes.items()])

    store("segment", cube.segment_catalogue(counted))
    store("road_name", profiles.profiled_roads(counts, min_observations=min_observations, base=cube.road_base_stats(counted)))
    named = read_profile(spark, root, "road_name")
    store("road_index", profiles.road_index(named))
    store("road_profile", profiles.one_per_id(named))
    roads = read_profile(spark, root, "road_profile")
    store("road_hour", profiles.by_road_id(roads, profiles.road_hour_profile(counts)))
    store("road_mix", profiles.by_road_id(roads, long(
        direction=profiles.road_direction_mix(counts), vehicle=profiles.road_vehicle_mix(counts),
    )))
    store("region_profile", profiles.region_profile(counts, roads))
    regions = read_profile(spark, root, "region_profile")
    store("region_hour", profiles.region_hour_profile(counts).join(
        regions.select("region_name"), "region_name", "left_semi"
    ))
    shares = profiles.region_road_share(counts, roads).withColumnRenamed("road_id", "key")
    store("region_mix", long(
        vehicle=profiles.region_vehicle_mix(counts, roads),
        direction=profiles.region_direction_mix(counts, roads),
        authority=profiles.region_authority_mix(counts, roads),
        road=shares,
    ))
    store("meta", profiles.profile_meta(
        roads, regions, read_profile(spark, root, "segment"), min_observations=min_observations
    ).withColumn("generated_at", F.current_timestamp()))
