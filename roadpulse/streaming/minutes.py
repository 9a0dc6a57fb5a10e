"""Closed minutes with versions, and the log of their corrections.

A batch closes the minutes that end the delay before the newest event it knows of; its run log entry
says up to when. The rows of a minute from all batches so far become its first version, in
``minutes``. What a later batch brings for it goes to the log of corrections, ``gold_late``. A batch
that could only write to the spare root closes nothing, and all its rows go to the log, since it may
not know what is closed. Whether a row is late depends on its minute and its batch alone, so each row
of gold is either in a first version or in the log: together they are the roll-up of all events,
however these were dealt to batches and however late they came.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.gold import merge_gold_partials
from roadpulse.schemas import STORED_GOLD
from roadpulse.sinks import writers

if TYPE_CHECKING:
    from roadpulse.streaming.medallion import Layout


def _jobs():
    from roadpulse.streaming import medallion

    return medallion


def closed_upto(spark: SparkSession, layout: Layout, *, log: DataFrame | None = None) -> datetime | None:
    """Minutes that end at or before this time are closed (by the batches of ``log``, if given)."""
    log = _jobs().run_log(spark, layout) if log is None else log
    return log.where("source_root = 0").agg(F.max("closed_upto")).first()[0]


def _ended(edge: datetime | None) -> Column:
    end = F.col("event_timestamp") + F.make_dt_interval(mins=F.lit(1))
    return F.lit(False) if edge is None else end <= F.lit(edge)


def close(
    rows: DataFrame, layout: Layout, root: str, batch_id: int, newest: datetime | None, log: DataFrame, *, failover: bool = False
) -> datetime | None:
    """What a batch does to the minutes; returns up to when they are closed now. ``rows`` is its
    gold, ``newest`` the newest event with it, ``log`` the run log of the batches before it: nothing
    else is read, so a retry writes the same."""
    spark = rows.sparkSession
    if failover:
        writers.write_gold(rows, f"{root}/gold_late", batch_id, failover=True)
        return None
    before = closed_upto(spark, layout, log=log)
    if before is not None:
        # Writes no file where nothing is late.
        writers.write_gold(rows.where(_ended(before)), f"{root}/gold_late", batch_id)
    if newest is None:
        return before
    now = newest - timedelta(minutes=_jobs().LATE_MINUTES)
    if before is not None and now <= before:
        return before
    closing = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    if batch_id > 0:
        # Only the hours that have been passed over are listed; none of them is folded yet. Rows of
        # batches in the spare root are in its log.
        span = {} if before is None else {"minutes": int((now - before) / timedelta(minutes=1)) + 2, "newest": now}
        earlier = _jobs().read_batches(spark, layout, "gold", STORED_GOLD, log=log, **span)
        closing = closing.unionByName(earlier.where("NOT writer_failover_active").drop("dt", "hour"))
    closing = closing.where(_ended(now) & ~_ended(before))
    writers.write_gold(merge_gold_partials(closing), f"{root}/minutes", batch_id)
    return now


def corrections(spark: SparkSession, layout: Layout, *, minutes: int = 0) -> DataFrame:
    """The log: what batches brought for minutes that were closed, or while the spare root was in use."""
    return _jobs().read_batches(spark, layout, "gold_late", STORED_GOLD, minutes=minutes)


def read_minutes(spark: SparkSession, layout: Layout, *, minutes: int = 0) -> DataFrame:
    """Every closed minute in its latest version: gold columns, one row per key and minute, and
    ``version``, the last batch that the minute took anything from. Lengths of regions and
    authorities come from the road rows, so a late road counts with its length."""
    jobs = _jobs()
    folded = jobs.read_folded(spark, layout, "minutes_folded", minutes=minutes)
    first = jobs.read_batches(spark, layout, "minutes", STORED_GOLD, minutes=minutes)
    fresh = jobs.unfolded(first.unionByName(corrections(spark, layout, minutes=minutes)), folded)
    rows = fresh.unionByName(folded.withColumnRenamed("upto", "batch_id")).where(_ended(closed_upto(spark, layout)))
    versions = rows.groupBy(F.col("event_timestamp").alias("_minute")).agg(F.max("batch_id").alias("version"))
    return merge_gold_partials(rows).join(versions, F.col("event_timestamp") == F.col("_minute")).drop("_minute")


def open_minutes(spark: SparkSession, layout: Layout) -> DataFrame:
    """What has been seen so far of the minutes that are not closed yet."""
    edge = closed_upto(spark, layout)
    rows = _jobs().read_gold(spark, layout)
    if edge is not None:
        rows = rows.where(F.concat("dt", "hour") >= (edge - timedelta(minutes=1)).astimezone(timezone.utc).strftime("%Y%m%d%H"))
    return merge_gold_partials(rows.where(~_ended(edge)))
