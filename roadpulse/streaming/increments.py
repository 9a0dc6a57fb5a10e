"""New vehicles per batch and region, from the gold files as they appear.

A second stream after the main job: each refresh reads only the files it has not seen and stores its
sums under its own number, so a restart repeats nothing and a batch may spread over refreshes.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.analytics import batch_increment
from roadpulse.schemas import STORED_GOLD
from roadpulse.sources.streams import gold_stream
from roadpulse.sources.tables import table_or_empty
from roadpulse.streaming.medallion import Layout, complete_batches, newest_event

_SUMS = (
    "batch_id long, source_root int, role string, region_name string, event_timestamp timestamp, total_vehicles long, "
    "dt string, hour string, refresh long"
)


def run_increments(
    spark: SparkSession, layout: Layout, root: str, checkpoint: str, *, max_files: int | None = None, available_now: bool = False
) -> StreamingQuery:
    """Start the refreshes: sums of the new gold files per batch, region and minute below ``root``
    (``dt= / hour= / refresh=``). A refresh that runs again replaces what it wrote."""
    parts = []
    for n, base in enumerate(layout.roots):
        path = f"{base}/gold"
        # A spare root may not have any gold yet; the stream needs its folder.
        spark.createDataFrame([], STORED_GOLD).write.mode("ignore").partitionBy("dt", "hour", "batch_id").parquet(path)
        parts.append(gold_stream(spark, path, STORED_GOLD, max_files=max_files).withColumn("source_root", F.lit(n)))

    def refresh(rows: DataFrame, number: int) -> None:
        # Authority rows take no part, primary and road rows stay apart as they do in the batch form.
        sums = rows.where("role <> 'authority'").groupBy(
            "batch_id", "source_root", "role", "region_name", "event_timestamp", "dt", "hour").agg(F.sum("total_vehicles").alias("total_vehicles"))
        sums.withColumn("refresh", F.lit(number).cast("bigint")).hint("rebalance", F.col("dt"), F.col("hour")).write.mode(
            "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt", "hour", "refresh").parquet(root)

    writer = reduce(DataFrame.unionByName, parts).writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    return writer.trigger(**trigger).start()


def read_increments(spark: SparkSession, layout: Layout, root: str, *, minutes: int = 0, keep: int | None = None) -> DataFrame:
    """``analytics.batch_increment`` of all complete batches. ``minutes`` counts only rows that long
    before the newest event, whose hours alone are read."""
    sums = table_or_empty(spark, root, _SUMS)
    newest = newest_event(spark, layout) if minutes > 0 else None
    if newest is not None:
        start = F.lit(newest - timedelta(minutes=minutes))
        folder = F.concat(F.col("dt"), F.col("hour"))
        sums = sums.where((folder >= F.date_format(start, "yyyyMMddHH")) & (folder <= F.date_format(F.lit(newest), "yyyyMMddHH")))
        sums = sums.where((F.col("event_timestamp") >= start) & (F.col("event_timestamp") <= F.lit(newest)))
    whole = sums.join(complete_batches(spark, layout), ["batch_id", "source_root"], "left_semi")
    return batch_increment(whole, keep=keep)
