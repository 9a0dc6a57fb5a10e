"""Scoring of requests against profiles, short forecasts and forecast error.

Profiles join to requests on their keys without broadcast hints: the adaptive plan
broadcasts a side once its measured size allows it and splits skewed keys otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.aggregates import last_rows, shares
from roadpulse.functions.text import strip

MODEL = "baseline-hourly-profile"
NOTES = "Prediction from aggregated hourly profiles and the base rate per minute."

# Limits of the deterministic road rate.
MIN_REGION_RATE_PER_MINUTE = 10.0
MIN_REGION_RATE_RATIO = 0.75
MIN_ROAD_RATE_PER_MINUTE = 2.0
MIN_ROAD_RATE_RATIO = 0.25


def _no_match(requests: DataFrame) -> Column:
    """A join key that equals no other: requests without a key spread over all tasks, where a null
    key would send them to one."""
    return F.concat(F.lit("\x00"), F.xxhash64(*requests.columns).cast("string"))


def lookup_profile(requests: DataFrame, roads: DataFrame) -> DataFrame:
    """Requests with their profile: by id, else by name in any case; the last road of a name wins.

    Unmatched requests stay, with ``status`` = ``not_found``.
    """
    profile = roads.select(
        F.col("road_id").alias("profile_road_id"), F.col("road_name").alias("profile_road_name"),
        F.col("baseline_rate_per_minute").alias("baseline"),
    )
    name_key = F.lower(strip(F.col("profile_road_name")))
    by_name = (
        profile.where(name_key != "").groupBy(name_key.alias("_name_key"))
        .agg(F.max_by(
            F.struct("profile_road_id", "profile_road_name", "baseline"),
            F.struct("profile_road_name", "profile_road_id"),
        ).alias("_named"))
    )
    wanted = requests.withColumns({
        "_id": F.nullif("road_id", F.lit("")),
        "_name": F.nullif(F.lower(strip(F.col("road_name"))), F.lit("")),
    })
    nobody = _no_match(requests)
    wanted = wanted.withColumns({"_id": F.coalesce("_id", nobody), "_name": F.coalesce("_name", nobody)})
    joined = wanted.join(profile, F.col("_id") == F.col("profile_road_id"), "left").join(
        by_name, F.col("_name") == F.col("_name_key"), "left"
    )
    found = F.col("profile_road_id").isNotNull()
    picked = {
        c: F.when(found, F.col(c)).otherwise(F.col(f"_named.{c}"))
        for c in ("profile_road_name", "baseline", "profile_road_id")
    }
    return (
        joined.select(*requests.columns, *[v.alias(k) for k, v in picked.items()])
        .withColumn("status", F.when(F.col("profile_road_id").isNull(), "not_found").otherwise("ok"))
    )


def predict(
    requests: DataFrame, roads: DataFrame, hours: DataFrame, directions: DataFrame,
    *, now_hour: Column | None = None,
) -> DataFrame:
    """Expected flow with bounds for every request.

    ``hours`` holds (road_id, hour, mean_per_minute, std_per_minute), ``directions``
    (road_id, key, weight). Requests without a profile keep nulls and ``not_found``; an
    hour outside 0..23 gives ``bad_hour``.
    """
    now = F.hour(F.current_timestamp()) if now_hour is None else now_hour
    looked = lookup_profile(requests, roads).withColumn("hour", F.coalesce("hour_of_day", now))
    hour = hours.select(
        F.col("road_id").alias("profile_road_id"), "hour",
        F.col("mean_per_minute").alias("hour_mean"), F.col("std_per_minute").alias("hour_std"),
    )
    count = directions.groupBy("road_id").agg(F.count(F.lit(1)).alias("_n"))
    named = directions.groupBy("road_id", F.lower("key").alias("direction_key")).agg(
        F.min_by(F.struct("key", "weight"), "key").alias("d")
    )
    direction = named.join(count, "road_id").select(
        F.col("road_id").alias("profile_road_id"), "direction_key",
        F.col("d.key").alias("direction_name"), (F.col("d.weight") * F.col("_n")).alias("multiplier"),
    )
    looked = looked.withColumns({
        "direction_key": F.coalesce(F.lower(F.nullif("direction", F.lit(""))), F.lit("")),
        "_road": F.coalesce("profile_road_id", _no_match(requests)),
    })
    joined = (
        looked.join(hour.withColumnRenamed("profile_road_id", "_road"), ["_road", "hour"], "left")
        .join(direction.withColumnRenamed("profile_road_id", "_road"), ["_road", "direction_key"], "left")
    )
    zero = F.lit(0.0)
    base = F.coalesce("baseline", zero)
    rate = F.greatest(F.coalesce(F.nullif("hour_mean", zero), base), zero)
    std = F.greatest(F.coalesce("hour_std", zero), zero)
    # The bounds move with the rate; a rate that stays at 0 moves nothing.
    turn = F.when(F.col("_rate") * F.greatest("multiplier", zero) > 0, F.col("multiplier")).otherwise(F.lit(1.0))
    factor = F.col("scaling_factor")
    scale = F.when(factor.isNull() | factor.isin(0.0, 1.0), F.lit(1.0)).otherwise(F.greatest(factor, zero))
    ok = (F.col("status") == "ok") & F.col("hour").between(0, 23)
    only = lambda c: F.when(ok, c)
    return (
        joined.withColumns({"_rate": rate, "_std": std})
        .withColumn("_turn", turn * scale)
        .select(
            *[c for c in requests.columns if c not in ("road_id", "road_name", "hour_of_day")],
            F.when((F.col("status") == "ok") & ~F.col("hour").between(0, 23), "bad_hour")
            .otherwise(F.col("status")).alias("status"),
            F.lit(MODEL).alias("model"),
            F.coalesce(F.nullif("road_id", F.lit("")), "profile_road_id").alias("road_id"),
            F.coalesce("profile_road_name", "road_name", "road_id").alias("road_name"),
            F.col("hour").alias("hour_of_day"),
            only(F.col("_rate") * F.col("_turn")).alias("expected_flow_per_minute"),
            only(F.greatest(F.col("_rate") - 2 * F.col("_std"), zero) * F.col("_turn")).alias("lower_bound_per_minute"),
            only(F.greatest(F.col("_rate") + 2 * F.col("_std"), zero) * F.col("_turn")).alias("upper_bound_per_minute"),
            only(F.col("_rate") * F.col("_turn") * 60).alias("expected_flow_per_hour"),
            only(F.col("direction_name")).alias("direction_applied"),
            only(F.when(F.col("_std") > 0, "medium").otherwise("low")).alias("confidence_level"),
            F.lit(NOTES).alias("notes"),
        )
    )


def direction_maps(directions: DataFrame) -> DataFrame:
    """The direction shares of a road as one MAP, for responses that carry it."""
    return directions.groupBy("road_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "weight")))).alias("distribution_direction")
    )


def scaling_factor(series: DataFrame, by: Sequence[str] = (), *, points: int = 12) -> DataFrame:
    """Last value over the mean of the last ``points`` values, clamped to 0.25 … 2.5."""
    recent = last_rows(series, by, [F.desc("minute")], points)
    keys = list(by)
    return recent.groupBy(*keys).agg(
        F.avg("value").alias("_mean"), F.max_by("value", "minute").alias("_last")
    ).select(
        *keys,
        F.when(
            F.col("_mean") > 0,
            F.greatest(F.least(F.col("_last") / F.col("_mean"), F.lit(2.5)), F.lit(0.25)),
        ).otherwise(F.lit(1.0)).alias("scaling_factor"),
    )


def forecast(series: DataFrame, expected: DataFrame, by: Sequence[str] = (), *, horizon: int = 5) -> DataFrame:
    """The next minutes: the recent trend blends into the expected flow.

    ``expected`` holds ``expected_flow_per_minute`` per group (one row without ``by``).
    """
    keys = list(by)
    tail = last_rows(series, by, [F.desc("minute")], 5).groupBy(*keys).agg(
        F.max("minute").alias("_last_minute"),
        F.max_by("value", "minute").alias("_last"),
        F.min_by("value", "minute").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
    )
    flow = "expected_flow_per_minute"
    if keys:
        both = tail.join(expected.select(*keys, flow), keys)
    else:
        both = tail.withColumn(flow, expected.select(flow).scalar()).where(F.col("_n") > 0)
    trend = (F.col("_last") - F.col("_first")) / F.greatest(F.col("_n") - 1, F.lit(1))
    m = F.col("m")
    blend = m / F.lit(float(horizon))
    value = (1 - blend) * (F.col("_last") + trend * m) + blend * F.greatest(F.col(flow), F.lit(0.0))
    return both.withColumn("m", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(
        *keys,
        (F.col("_last_minute") + F.make_dt_interval(mins=m)).alias("target_ts"),
        F.greatest(value, F.lit(0.0)).alias("value"),
    )


def kept_predictions(
    predictions: DataFrame, by: Sequence[str] = (), *, as_of: Column, keep: int = 12, history_minutes: int = 1440
) -> DataFrame:
    """The last ``keep`` predictions of every target minute that is not too old."""
    fresh = predictions.where(
        F.col("target_ts").isNotNull() & F.col("value").isNotNull()
        & (F.col("target_ts") >= as_of - F.make_dt_interval(mins=F.lit(history_minutes)))
    )
    return last_rows(fresh, [*by, "target_ts"], [F.desc("generated_at")], keep)


def prediction_history(predictions: DataFrame, by: Sequence[str] = (), **limits) -> DataFrame:
    """Per target minute, the latest prediction and how many are kept."""
    return kept_predictions(predictions, by, **limits).groupBy(*by, "target_ts").agg(
        F.max_by("value", "generated_at").alias("value"),
        F.max("generated_at").alias("generated_at"),
        F.count(F.lit(1)).alias("kept"),
    )


def worst_prediction(series: DataFrame, kept: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per observed minute, the kept prediction that missed most, the earliest on ties."""
    observed = series.select(*by, "minute", F.col("value").alias("observed"))
    paired = kept.withColumnRenamed("target_ts", "minute").join(observed, [*by, "minute"])
    paired = paired.withColumn("absolute_error", F.abs(F.col("observed") - F.col("value")))
    worst = last_rows(paired, [*by, "minute"], [F.desc("absolute_error"), F.asc("generated_at")], 1)
    return worst.select(
        *by, "minute", F.col("value").alias("worst_prediction"), "observed", "absolute_error"
    )


def normalise_weights(weights: DataFrame, by: Sequence[str], weight: str = "weight") -> DataFrame:
    """Finite positive weights rescaled to sum to one per group."""
    return shares(weights, by, weight, weight)


def expected_road_rate(
    roads: DataFrame, road_hours: DataFrame, road_shares: DataFrame,
    regions: DataFrame, region_hours: DataFrame,
) -> DataFrame:
    """Expected rate of every road and hour: its weight's part of the region's mean rate.

    ``road_hours`` and ``region_hours`` are completed hour profiles.
    """
    floor = lambda c, least: F.greatest(c, F.lit(least))
    hours = F.explode(F.sequence(F.lit(0), F.lit(23)))
    road = roads.select("region_name", "road_id", "baseline_rate_per_minute", hours.alias("hour"))
    weighted = (
        road.join(road_hours.select("road_id", "hour", "mean_per_minute"), ["road_id", "hour"], "left")
        .join(road_shares.select("region_name", "road_id", F.col("weight").alias("share")), ["region_name", "road_id"], "left")
        .select(
            "region_name", "hour", "road_id",
            (
                floor(F.coalesce("mean_per_minute", "baseline_rate_per_minute"), 0.001)
                * floor(F.coalesce("share", F.lit(1.0)), 0.001)
            ).alias("w"),
        )
    )
    probability = shares(weighted, ["region_name", "hour"], "w", "probability")
    region = regions.select("region_name", F.col("baseline_rate_per_minute").alias("base"), hours.alias("hour")).join(
        region_hours.select("region_name", "hour", "mean_per_minute"), ["region_name", "hour"], "left"
    )
    mean = F.greatest(F.coalesce("mean_per_minute", "base"), "base", F.lit(0.1))
    least = F.greatest(
        mean * MIN_REGION_RATE_RATIO, F.col("base") * MIN_REGION_RATE_RATIO, F.lit(MIN_REGION_RATE_PER_MINUTE)
    )
    region = region.select("region_name", "hour", F.greatest(mean, least).alias("region_rate"))
    return probability.join(region, ["region_name", "hour"]).select(
        "region_name", "road_id", "hour", "probability", "region_rate",
        F.greatest(
            F.col("region_rate") * F.col("probability"),
            F.col("region_rate") * MIN_ROAD_RATE_RATIO,
            F.lit(MIN_ROAD_RATE_PER_MINUTE),
        ).alias("road_rate"),
    )
