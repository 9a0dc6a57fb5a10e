"""Folding and retention for the tables of the stream job.

Every fold is written beside what it replaces and says up to which batch it goes; readers skip
older pieces by that number. So removing the pieces is only cleaning up, and a job that stops
half way changes no result. It may run while the stream job does.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.gold import merge_gold_partials
from roadpulse.schemas import FOLDED_GOLD, STORED_GOLD
from roadpulse.streaming import state
from roadpulse.streaming.medallion import FOLDED_LOG, Layout, newest_event, read_batches, read_folded, run_log, unfolded
from roadpulse.streaming.minutes import closed_upto

_BY_DAY = ("silver", "gold", "gold_late", "gold_folded", "minutes", "minutes_folded", "event_ids", "id_filters")
_STATE = ("stats", "directions", "meta")


def maintain(spark: SparkSession, layout: Layout, *, keep_days: int | None = None) -> None:
    """Fold closed hours, the running state and the run log; then remove what the folds replaced.
    ``keep_days`` also removes the days older than that before the newest event, or before the
    newest complete batch was read if that is earlier: an event dated after its reading moves
    nothing. None keeps every day."""
    last, read_at = run_log(spark, layout).agg(F.max("batch_id"), F.max_by("last_flush_time", "batch_id")).first()
    newest = newest_event(spark, layout)
    if last is None or newest is None:
        return
    folds = {}
    # What is not closed yet must stay apart until it is.
    if (edge := closed_upto(spark, layout)) is not None:
        for into, tables in (("gold_folded", ("gold",)), ("minutes_folded", ("minutes", "gold_late"))):
            folds[into, tables] = fold_gold(spark, layout, edge, last, tables, into)
    state.compact(spark, [f"{root}/state" for root in layout.roots], last)
    fold_run_log(spark, layout, last)

    files = Files(spark)
    first_day = None if keep_days is None else _first_day(newest, read_at, keep_days)
    for root in layout.roots:
        for (folded, tables), hours in folds.items():
            for dt, hour in hours:
                for table in tables:
                    files.remove_numbered(f"{root}/{table}/dt={dt}/hour={hour}", "batch_id=", last + 1)
                files.remove_numbered(f"{root}/{folded}/dt={dt}/hour={hour}", "upto=", last)
        for name in _STATE:
            files.remove_numbered(f"{root}/state/{name}/delta", "batch_id=", last + 1)
            files.remove_numbered(f"{root}/state/{name}/snapshot", "upto=", last)
        files.remove_numbered(f"{root}/run_log", "batch_id=", last + 1)
        files.remove_numbered(f"{root}/run_log_folded", "upto=", last)
        for table in _BY_DAY if first_day is not None else ():
            files.remove_numbered(f"{root}/{table}", "dt=", first_day)


def _first_day(newest: datetime, read_at: float | None, keep_days: int) -> int | None:
    """The first day to keep, as yyyymmdd; none where the reading time is not known."""
    if read_at is None:
        return None
    edge = min(newest.astimezone(timezone.utc), datetime.fromtimestamp(read_at, timezone.utc))
    return int((edge - timedelta(days=keep_days)).strftime("%Y%m%d"))


def fold_gold(
    spark: SparkSession, layout: Layout, before: datetime, upto: int, tables: tuple[str, ...] = ("gold",), into: str = "gold_folded"
) -> list[tuple[str, str]]:
    """One row per key and minute for the hours that ended before ``before``, of the batches up to
    ``upto``; for ``minutes`` and ``gold_late`` the latest versions. Only hours with partial rows are
    touched; their names (dt, hour) come back."""
    ended = before.astimezone(timezone.utc).strftime("%Y%m%d%H")
    closed = F.concat("dt", "hour") < F.lit(ended)
    partial = reduce(DataFrame.unionByName, [read_batches(spark, layout, t, STORED_GOLD) for t in tables])
    folded = read_folded(spark, layout, into).where(closed)
    fresh = unfolded(partial.where(closed & (F.col("batch_id") <= upto)), folded)
    hours = sorted(tuple(r) for r in fresh.select("dt", "hour").distinct().collect())  # one short row per unfolded hour
    if hours:
        wanted = spark.createDataFrame(hours, "dt string, hour string")
        before_fold = folded.join(F.broadcast(wanted), ["dt", "hour"], "left_semi").withColumnRenamed("upto", "batch_id")
        flagged = F.lit(False).alias("writer_failover_active")
        merged = merge_gold_partials(fresh.unionByName(before_fold)).drop("writer_failover_active", "batch_id")
        _write_folded(merged.select("*", flagged), layout.path(into), upto)
    return hours


def _write_folded(rows: DataFrame, path: str, upto: int) -> None:
    stored = rows.withColumns({
        "dt": F.date_format("event_timestamp", "yyyyMMdd"), "hour": F.date_format("event_timestamp", "HH"),
        "upto": F.lit(upto).cast("bigint"),
    }).select(*FOLDED_GOLD.names)
    stored.hint("rebalance", F.col("dt"), F.col("hour")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("dt", "hour", "upto").parquet(path)


def fold_run_log(spark: SparkSession, layout: Layout, upto: int) -> None:
    """All entries up to ``upto`` in one table; a new fold replaces the last one when read."""
    entries = run_log(spark, layout).where(F.col("batch_id") <= upto).withColumn("upto", F.lit(upto).cast("bigint"))
    entries.select(*FOLDED_LOG.names).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("upto").parquet(layout.path("run_log_folded"))


class Files:
    """Folder removal through Hadoop's file system, whatever store the path is in."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def remove_numbered(self, folder: str, prefix: str, below: int) -> int:
        """Remove the sub-folders ``<prefix><number>`` with a number under ``below``; absent folders
        have none. Returns how many went."""
        path = self.path(folder)
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(path):
            return 0
        gone = 0
        for status in store.listStatus(path):
            name = status.getPath().getName()
            number = name.removeprefix(prefix)
            if name.startswith(prefix) and number.lstrip("-").isdigit() and int(number) < below:
                gone += bool(store.delete(status.getPath(), True))
        return gone
