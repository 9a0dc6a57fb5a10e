"""No query may hold a plan that does not scale."""

from __future__ import annotations

import re

import pytest

from roadpulse.plans.catalog import queries

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(queries()))
def test_plan(spark, sf, name):
    plan = plan_of(queries()[name](spark, sf))
    assert not [op for op in FORBIDDEN if op in plan]
    # A window without a partition would pull its input into one task.
    for window in re.findall(r"Window \[.*?\], \[(.*?)\]", plan):
        assert window, plan


def test_gold_spreads_one_region_and_minute(spark, sf):
    from pyspark.sql import functions as F

    from roadpulse.operators import gold
    from roadpulse.plans import inputs

    plan = plan_of(queries()["gold_all"](spark, sf))
    exchanges = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert len(exchanges) == 3 and sum("road_key" in e for e in exchanges) == 3
    # All events in one region and minute: the middle exchange fills more than one task.
    one = inputs.events(spark, sf).withColumns({"region_name": F.lit("R"), "minute": F.lit("2024-01-01").cast("timestamp")})
    moved = gold._road_partials(one, ()).repartition(8, "region_name", "road_key", "minute")
    assert moved.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_scans_compile_to_methods_the_jvm_takes(spark, sf):
    """No stage method beyond the limit above which the JVM interprets it."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    for name in ("clean_counts", "segment_catalogue", "normalise_events", "gold_all"):
        df = queries()[name](spark, sf)
        for line in spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(
                df._jdf.queryExecution().executedPlan()).splitlines():
            if found := re.search(r"maxMethodCodeSize:(\d+)", line):
                # Larger ones are not compiled as one stage: their operators run apart.
                assert int(found[1]) < 64000


def test_no_null_join_keys_in_scoring(spark, sf):
    plan = queries()["predict"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan


def test_latest_per_road_sorts_no_wide_rows(spark, sf, tmp_path):
    from roadpulse.operators.analytics import latest_per_road
    from roadpulse.plans import inputs

    inputs.live(spark, sf).limit(20).write.parquet(str(tmp_path / "gold"))
    plan = plan_of(latest_per_road(spark.read.parquet(str(tmp_path / "gold"))))
    # The only sort aggregate (its two halves) works on the rows that a semi join has left.
    parts = plan.split("SortAggregate")
    assert len(parts) == 3 and "LeftSemi" in parts[-1]


def test_scans_read_only_what_they_need(spark, sf):
    plan = plan_of(queries()["road_hour_profile"](spark, sf))
    line = next(p for p in plan.splitlines() if "FileScan parquet" in p and "l_orderkey" in p)
    assert "l_extendedprice" not in line and "l_quantity" in line


def test_gold_is_evaluated_once(spark, sf, tmp_path):
    """The fold of partial rows and the series of minutes read stored gold once: other uses share its exchange."""
    from roadpulse.operators import analytics, gold
    from roadpulse.plans import inputs

    inputs.gold_partials(spark, sf).limit(50).write.parquet(str(tmp_path / "partials"))
    inputs.live(spark, sf).limit(50).write.parquet(str(tmp_path / "gold"))
    merged = gold.merge_gold_partials(spark.read.parquet(str(tmp_path / "partials")))
    assert plan_of(merged).count("FileScan parquet") == 1
    series = analytics.minute_series(spark.read.parquet(str(tmp_path / "gold")), minutes=60)
    series.collect()
    plan = plan_of(series)
    assert "scalar-subquery" not in plan and "ReusedExchange" in plan
