"""Running profiles: per-batch statistics that merge into a state.

A state row is (count, mean, m2) for one road and hour; hour null is the road's
overall statistic. One observation is the total of one road in one minute of one batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from roadpulse.functions.aggregates import shares
from roadpulse.functions.measures import round_half_even
from roadpulse.functions.text import first_text, slugify
from roadpulse.schemas import META_FIELDS


def _identified(events: DataFrame) -> DataFrame:
    return events.where(F.col("road_id") != "")


def minute_totals(events: DataFrame) -> DataFrame:
    """Vehicles per identified road and minute."""
    return _identified(events).groupBy("road_id", "minute").agg(F.sum("vehicle_count").alias("total"))


def batch_stats(totals: DataFrame) -> DataFrame:
    """(count, mean, m2) per road and hour, plus the overall rows (hour null)."""
    value = F.greatest("total", F.lit(0.0))
    return (
        totals.withColumn("hour", F.explode(F.array(F.hour("minute"), F.lit(None).cast("int"))))
        .groupBy("road_id", "hour")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(F.lit(1))).alias("m2"),
        )
    )


def merge_stats(parts: DataFrame) -> DataFrame:
    """Parallel merge of any number of (count, mean, m2) rows per road and hour.

    The window spans the parts of one key only: one row per batch since the last compaction.
    """
    key = W.partitionBy("road_id", "hour")
    n, mean = F.col("count"), F.col("mean")
    grand = F.sum(n * mean).over(key) / F.nullif(F.sum(n).over(key), F.lit(0))
    return (
        parts.withColumn("_grand", F.coalesce(grand, F.lit(0.0)))
        .groupBy("road_id", "hour")
        .agg(
            F.sum(n).alias("count"),
            F.max("_grand").alias("mean"),
            F.sum(F.col("m2") + n * (mean - F.col("_grand")) * (mean - F.col("_grand"))).alias("m2"),
        )
    )


def direction_counts(events: DataFrame) -> DataFrame:
    """Vehicles per road and direction; every event counts at least one."""
    counted = F.greatest(round_half_even(F.col("vehicle_count")), F.lit(1).cast("bigint"))
    return (
        _identified(events).where(F.col("direction").isNotNull())
        .groupBy("road_id", "direction").agg(F.sum(counted).alias("count"))
    )


def merge_directions(parts: DataFrame) -> DataFrame:
    return parts.groupBy("road_id", "direction").agg(F.sum("count").alias("count"))


def batch_metadata(events: DataFrame, *, batch: Sequence[str] = ()) -> DataFrame:
    """Descriptors of each road's first event in the batch; ``batch`` names the columns that tell
    batches apart where the events are of several."""
    cols = [F.col(f"meta_{n}").alias(n) for n in META_FIELDS]
    keys = ["road_id", *batch]
    seen = _identified(events).select(*keys, "arrival", *cols)
    seen = seen.groupBy(*keys, *META_FIELDS).agg(F.min("arrival").alias("arrival"))
    first = seen.groupBy(*keys).agg(
        F.min_by(F.struct(*META_FIELDS), F.struct("arrival", *META_FIELDS)).alias("m")
    )
    return first.select(*keys, "m.*")


def merge_metadata(parts: DataFrame, order: str) -> DataFrame:
    """Per road and descriptor, the earliest non-empty value over the batches."""
    pick = lambda n: F.coalesce(
        F.min_by(n, F.when(F.col(n) != "", F.struct(order, n))), F.lit("")
    ).alias(n)
    return parts.groupBy("road_id").agg(*[pick(n) for n in META_FIELDS])


def runtime_road_profile(stats: DataFrame, meta: DataFrame) -> DataFrame:
    overall = stats.where(F.col("hour").isNull())
    named = lambda c, default: F.coalesce(F.nullif(F.col(c), F.lit("")), default)
    return overall.join(meta, "road_id", "left").select(
        "road_id",
        named("road_name", F.col("road_id")).alias("road_name"),
        named("region_name", F.lit("Unknown")).alias("region_name"),
        F.coalesce(
            first_text(F.col("region_id")),
            F.concat(F.lit("region:"), slugify(named("region_name", F.lit("Unknown")), unicode=True)),
        ).alias("region_id"),
        named("local_authority_name", F.lit("Unknown")).alias("local_authority_name"),
        F.coalesce("road_type", F.lit("")).alias("road_type"),
        F.when(F.col("count") > 0, F.col("mean")).otherwise(F.lit(0.0)).alias("baseline_rate_per_minute"),
        F.col("count").alias("observation_count"),
    )


def runtime_hours(stats: DataFrame, *, min_observations: int = 3) -> DataFrame:
    """Hour rows with enough observations."""
    least = max(1, int(min_observations))
    return stats.where(F.col("hour").isNotNull() & (F.col("count") >= least)).select(
        "road_id", "hour",
        F.col("mean").alias("mean_per_minute"),
        F.sqrt(F.greatest(F.col("m2") / F.col("count"), F.lit(0.0))).alias("std_per_minute"),
        F.col("count").alias("observations"),
    )


def runtime_direction_mix(counts: DataFrame) -> DataFrame:
    return shares(counts.withColumnRenamed("direction", "key"), ["road_id"], "count")


def runtime_region_profile(roads: DataFrame) -> DataFrame:
    """Per region: roads and the mean of their baselines. The road list is ``roads`` itself."""
    return roads.groupBy("region_id").agg(
        F.min("region_name").alias("region_name"),
        F.count(F.lit(1)).alias("road_count"),
        F.avg("baseline_rate_per_minute").alias("baseline_rate_per_minute"),
    )
