"""Profiles from the stored cube equal those from the counts, and a new day is all that is read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import cleaning, cube, profiles
from roadpulse.plans import inputs, profile_job
from roadpulse.plans.profile_job import build_profiles, read_cube, update_cube
from roadpulse.sinks.profiles import read_profile
from roadpulse.sources import driver_tables as src

NUMBERS = ("double", "float")


def same_rows(got, want, name=""):
    """Equal texts and counts; numbers equal but for the order of summing."""
    columns = sorted(want.dtypes, key=lambda c: (c[1] in NUMBERS, c[0]))
    names = [c for c, _ in columns]
    left, right = (sorted(df.select(*names).collect(), key=lambda r: [(v is not None, str(v)) for v, (_, kind) in zip(r, columns) if kind not in NUMBERS]) for df in (got, want))
    assert len(left) == len(right) and sorted(got.columns) == sorted(names), name
    for one, other in zip(left, right):
        for c, kind in columns:
            assert (one[c] == pytest.approx(other[c], rel=1e-9, abs=1e-9)) if kind in NUMBERS and None not in (one[c], other[c]) else one[c] == other[c], (name, c)


def clean_table(spark, sf):
    return cleaning.clean_counts(src.traffic_counts(spark, sf)).withColumn("dt", F.date_format("observation_date", "yyyy-MM-dd"))


def as_the_counts_say(spark, root, counts):
    """Every stored table against the functions over the counts themselves."""
    roads = profiles.road_profile(counts)
    regions = profiles.region_profile(counts, roads)
    mixes = [profiles.by_road_id(roads, m).withColumn("dim", F.lit(d)) for d, m in (
        ("direction", profiles.road_direction_mix(counts)), ("vehicle", profiles.road_vehicle_mix(counts)))]
    want = {
        "segment": profiles.segment_catalogue(counts), "road_profile": roads, "road_hour": profiles.by_road_id(roads, profiles.road_hour_profile(counts)),
        "road_mix": mixes[0].unionByName(mixes[1]), "region_profile": regions,
        "region_hour": profiles.region_hour_profile(counts).join(regions.select("region_name"), "region_name", "left_semi"),
    }
    for table, df in want.items():
        same_rows(read_profile(spark, root, table), df, table)
    shares = read_profile(spark, root, "region_mix").where("dim = 'road'").drop("dim").withColumnRenamed("key", "road_id")
    same_rows(shares, profiles.region_road_share(counts, roads), "shares")
    assert not read_profile(spark, root, "road_profile").isEmpty()


def test_only_changed_days_are_read(spark, sf, tmp_path, monkeypatch):
    clean, root = str(tmp_path / "clean"), str(tmp_path / "profiles")
    rows = clean_table(spark, sf)
    # Few folders: the days become months.
    rows = rows.withColumn("observation_date", F.trunc("observation_date", "year")).withColumn("dt", F.date_format("observation_date", "yyyy-MM-dd")).cache()
    days = [r.dt for r in rows.select("dt").distinct().orderBy("dt").collect()]
    store = lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(clean)
    store(rows.where(F.col("dt") < days[-2]))
    read = []
    counted = cube.count_cube
    monkeypatch.setattr(cube, "count_cube", lambda df, *a: (read.append(df.select("observation_date").distinct().count()), counted(df, *a))[1])
    build_profiles(spark, clean, root)
    assert read == [len(days) - 2]
    as_the_counts_say(spark, root, cleaning.prepare_counts(rows.where(F.col("dt") < days[-2])))
    # Two new days, one changed day.
    store(rows.where((F.col("dt") >= days[-2]) | ((F.col("dt") == days[0]) & (F.col("hour_of_day") % 2 == 0))))
    assert update_cube(spark, clean, root) == [f"d{d}" for d in sorted([days[0], *days[-2:]])]
    assert read == [len(days) - 2, 3] and update_cube(spark, clean, root) == []
    build_profiles(spark, clean, root)
    assert len(read) == 2
    as_the_counts_say(spark, root, cleaning.prepare_counts(rows.where((F.col("dt") != days[0]) | (F.col("hour_of_day") % 2 == 0))))
    # A day that goes is forgotten without reading anything.
    for file in (tmp_path / "clean" / f"dt={days[1]}").iterdir():
        file.unlink()
    assert update_cube(spark, clean, root) == [] and len(read) == 2
    assert read_cube(spark, root).where(F.col("observation_date") == days[1]).isEmpty()
    rows.unpersist()


def test_the_counts_are_scanned_once(spark, sf, tmp_path, monkeypatch):
    """After the cube is up to date nothing needs the clean table."""
    clean, root = tmp_path / "clean", str(tmp_path / "profiles")
    clean_table(spark, sf).drop("dt").write.parquet(str(clean))
    update = update_cube

    def and_hide(*args):
        changed = update(*args)
        clean.rename(tmp_path / "away")
        return changed

    monkeypatch.setattr(profile_job, "update_cube", and_hide)
    build_profiles(spark, str(clean), root)
    as_the_counts_say(spark, root, inputs.counts(spark, sf))
    plan = cube.count_cube(inputs.counts(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == inputs.counts(spark, sf)._jdf.queryExecution().executedPlan().toString().count("FileScan") and "SortAggregate" not in plan


def test_cube_deviations(spark):
    row = lambda n, lat, day: ("c", "A1", n, lat, day, 1.0)
    data = [row(n, 51.1 + 1e-9 * (n % 3), f"2020-01-{1 + n % 5:02d}") for n in range(50)] + [("c", "B2", 99, 51.123456789, "2020-01-01", 1.0)] * 7
    raw = spark.createDataFrame(data, "count_point_identifier string, road_name string, record_ord long, latitude double, observation_date string, all_motor_vehicle_count double")
    counts = cleaning.prepare_counts(raw.withColumn("hour_of_day", F.lit(7)))
    for n in ("link_length_kilometers", "link_length_miles"):
        counts = counts.withColumn(n, F.lit(None).cast("double"))
    got, want = ({r.road_name: r for r in f.collect()} for f in (cube.road_base_stats(cube.count_cube(counts)), profiles.road_base_stats(counts)))
    for road in ("A1", "B2"):
        assert got[road].latitude_mean == pytest.approx(want[road].latitude_mean, rel=1e-14)
        assert got[road].latitude_std == pytest.approx(want[road].latitude_std, rel=1e-3)
        assert (got[road].observation_count, got[road].days_observed) == (want[road].observation_count, want[road].days_observed)
    assert got["B2"].latitude_std == 0.0
