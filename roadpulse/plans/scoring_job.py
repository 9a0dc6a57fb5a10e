"""Batch job: score requests against stored profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.scoring import direction_maps, predict
from roadpulse.sinks.profiles import read_profile


def first_profile_root(spark: SparkSession, roots: Sequence[str]) -> str:
    """The first root that holds road profiles: running, then generated, then static."""
    for root in roots:
        try:
            if not read_profile(spark, root, "road_profile").isEmpty():
                return root
        except AnalysisException:
            continue
    raise FileNotFoundError("no profiles in any of: " + ", ".join(roots))


def score(
    spark: SparkSession, requests: DataFrame, roots: Sequence[str], *, now_hour: Column | None = None,
    with_distribution: bool = False,
) -> DataFrame:
    """Requests to responses, with the time of scoring and, if asked, each road's direction map."""
    root = first_profile_root(spark, roots)
    roads, hours, mix = (read_profile(spark, root, t) for t in ("road_profile", "road_hour", "road_mix"))
    directions = mix.where(F.col("dim") == "direction").select("road_id", "key", "weight")
    out = predict(requests, roads, hours, directions, now_hour=now_hour)
    out = out.withColumn("generated_at", F.current_timestamp())
    return out.join(direction_maps(directions), "road_id", "left") if with_distribution else out


def store_predictions(predictions: DataFrame, folder: str) -> None:
    """Add predictions (region_name, target_ts, generated_at, value, as ``scoring.forecast`` gives
    them with the time of forecasting) to the table that the error stream reads."""
    rows = predictions.select("region_name", "target_ts", "generated_at", F.col("value").cast("double").alias("value"))
    rows.write.mode("append").parquet(folder)
