"""One gold row per key and minute, straight from the stream, and closed-minute statistics.

The per-batch gold table may hold several rows of one minute. These queries wait until
the watermark closes a minute, so their rows do not depend on the batch boundaries.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.measures import ratio_or_zero
from roadpulse.operators.runtime import batch_stats
from roadpulse.schemas import CLASS_GOLD, GOLD_ADDITIVE
from roadpulse.sources.tables import table_or_empty

WATERMARK = "10 minutes"
_UPDATES = ", ".join([
    "region_name string, local_authority_name string, road_key string", *(f"{c} long" for c in GOLD_ADDITIVE),
    "length_km double, event_timestamp timestamp, dt string, hour string, version long",
])
_LEVELS = {
    "primary": ["region_name"],
    "authority": ["region_name", "local_authority_name"],
    "road": ["region_name", "local_authority_name", "road_key"],
}


def _by_road(events: DataFrame, keys: list[str], watermark: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("total_vehicles", "heavy_vehicles") + CLASS_GOLD]
    return (
        events.withWatermark("event_ts", watermark)
        .groupBy(F.window("event_ts", "1 minute").alias("w"), *dict.fromkeys([*keys, "road_key"]))
        .agg(
            *sums, F.count(F.lit(1)).alias("event_count"),
            F.max(F.when(F.col("link_length_km") > 0, F.col("link_length_km"))).alias("length_km"),
        )
    )


def gold_merged(events: DataFrame, role: str = "primary", *, watermark: str = WATERMARK) -> DataFrame:
    """Closed minutes of one level: a windowed aggregate per road, then one over the roads."""
    keys = _LEVELS[role]
    rolled = by_road = _by_road(events, keys, watermark)
    if role != "road":
        rolled = by_road.groupBy(F.window("w", "1 minute").alias("w"), *keys).agg(
            *[F.sum(c).alias(c) for c in GOLD_ADDITIVE], F.sum("length_km").alias("length_km")
        )
    return _measured(rolled.withColumn("event_timestamp", F.col("w.start")), role)


def _measured(rolled: DataFrame, role: str) -> DataFrame:
    length = F.coalesce("length_km", F.lit(0.0))
    return rolled.select(
        F.lit(role).alias("role"), *_LEVELS[role], "event_timestamp", *GOLD_ADDITIVE,
        (F.col("total_vehicles") / F.col("event_count")).alias("avg_vehicles"),
        length.alias("total_link_length_km"),
        ratio_or_zero(F.col("total_vehicles"), length).alias("vehicles_per_km"),
    )


def run_gold_merged(
    events: DataFrame, root: str, checkpoint: str, *, watermark: str = WATERMARK, available_now: bool = False
) -> list[StreamingQuery]:
    """Store the closed minutes of all three levels, one query and one table (``role``) each, by
    day. The file sink's log makes every minute count once. Each query has a watermark of its own and
    drops what comes later; the job's ``minutes`` take late events in as corrections."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "20 seconds"}
    started = []
    for role in _LEVELS:
        rows = gold_merged(events, role, watermark=watermark).withColumn("dt", F.date_format("event_timestamp", "yyyyMMdd"))
        writer = rows.writeStream.outputMode("append").format("parquet").partitionBy("dt").option("path", f"{root}/{role}")
        started.append(writer.option("checkpointLocation", f"{checkpoint}/{role}").trigger(**trigger).start())
    return started


def run_gold_updates(
    events: DataFrame, root: str, checkpoint: str, *, watermark: str = WATERMARK, available_now: bool = False
) -> StreamingQuery:
    """The minutes as they grow: each trigger stores the present sums of every road and minute that
    it changed, under its own number (``dt= / hour= / version=``). A trigger that runs again replaces
    what it wrote. ``read_updates`` takes the latest version of each."""

    def write(batch: DataFrame, batch_id: int) -> None:
        start = F.col("w.start")
        rows = batch.withColumns({
            "event_timestamp": start, "dt": F.date_format(start, "yyyyMMdd"), "hour": F.date_format(start, "HH"),
            "version": F.lit(batch_id).cast("bigint"),
        }).drop("w")
        rows.hint("rebalance", F.col("dt"), F.col("hour")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("dt", "hour", "version").parquet(root)

    writer = _by_road(events, _LEVELS["road"], watermark).writeStream.outputMode("update").foreachBatch(write)
    trigger = {"availableNow": True} if available_now else {"processingTime": "20 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_updates(spark: SparkSession, root: str, role: str = "primary") -> DataFrame:
    """All minutes seen so far, open ones included, in the columns of ``gold_merged``. The sums only
    grow, so a hash aggregate finds the latest version; regions and authorities add up their roads."""
    rows = table_or_empty(spark, root, _UPDATES)
    keys = [*_LEVELS["road"], "event_timestamp"]
    latest = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("version").alias("_version"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]) & (F.col("version") == F.col("_version"))
    roads = rows.join(latest, same, "left_semi")
    if role == "road":
        return _measured(roads, role)
    own = [*_LEVELS[role], "event_timestamp"]
    sums = [F.sum(c).alias(c) for c in GOLD_ADDITIVE]
    # A road that crosses authorities has one length at region level: its maximum.
    per_road = roads.groupBy(*own, "road_key").agg(*sums, F.max("length_km").alias("length_km"))
    return _measured(per_road.groupBy(*own).agg(*sums, F.sum("length_km").alias("length_km")), role)


def closed_minutes(events: DataFrame, *, watermark: str = WATERMARK) -> DataFrame:
    """Totals of identified roads for minutes that can no longer change."""
    return (
        events.where(F.col("road_id") != "").withWatermark("event_ts", watermark)
        .groupBy(F.window("event_ts", "1 minute").alias("w"), "road_id")
        .agg(F.sum("vehicle_count").alias("total"))
        .select("road_id", F.col("w.start").alias("minute"), "total")
    )


def run_closed_minutes(
    events: DataFrame, root: str, checkpoint: str, *, watermark: str = WATERMARK, available_now: bool = False
) -> StreamingQuery:
    """Running statistics fed by closed minutes: one observation per road and minute,
    however the events were batched. Deltas land where ``state.read_state`` looks."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_stats(batch).write.mode("overwrite").parquet(f"{root}/stats/delta/batch_id={batch_id}")

    writer = closed_minutes(events, watermark=watermark).writeStream.outputMode("append").foreachBatch(write)
    trigger = {"availableNow": True} if available_now else {"processingTime": "20 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
