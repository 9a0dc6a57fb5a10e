"""One stream to several sinks, each with its own record of what it holds.

A sink that fails lags: its batches wait in a spool, in order, while the others go on. At every
later trigger it tries again, oldest batch first, so it catches up alone. Nothing is spooled while
all sinks are well.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.sources.tables import table_or_empty

# A sink writes one batch under its number; writing it again must replace it.
Sink = Callable[[DataFrame, int], None]
# The number up to which a sink holds all batches stands in one of so many slots.
SLOTS = 64
_COMMITS = "upto long, sink string, slot int"
_WAITING = "at timestamp, batch_id long"


def committed(spark: SparkSession, root: str) -> dict[str, int]:
    """Per sink, the last batch up to which it holds everything."""
    rows = table_or_empty(spark, f"{root}/commits", _COMMITS).groupBy("sink").agg(F.max("upto").alias("upto"))
    return {r.sink: r.upto for r in rows.collect()}  # one row per sink


def waiting(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the spooled batches that some sink may lack, in order. The mark of a batch is
    written after its rows, so a batch in this list is whole."""
    return sorted(r.batch_id for r in table_or_empty(spark, f"{root}/spooled", _WAITING).select("batch_id").distinct().collect())


def lag(spark: SparkSession, root: str, sinks: Mapping[str, Sink]) -> dict[str, int]:
    """How many spooled batches each sink still has to take."""
    done, spooled = committed(spark, root), waiting(spark, root)
    return {name: sum(n > done.get(name, -1) for n in spooled) for name in sinks}


def _commit(spark: SparkSession, root: str, name: str, batch_id: int) -> None:
    row = spark.createDataFrame([(batch_id,)], "upto long")
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/sink={name}/slot={batch_id % SLOTS}")


def _take(spark: SparkSession, root: str, name: str, sink: Sink, batches: list[tuple[int, DataFrame]]) -> bool:
    """Give a sink its batches in order, up to the first that fails. Whether it took all."""
    for number, rows in batches:
        try:
            sink(rows, number)
        except Exception:
            logging.getLogger(__name__).exception("sink %s did not take batch %d", name, number)
            return False
        _commit(spark, root, name, number)
    return True


def fan_out_batch(batch: DataFrame, batch_id: int, sinks: Mapping[str, Sink], root: str) -> None:
    """What one micro-batch gives to every sink. A retry of the batch gives it only to sinks that lack it.
    If the spool cannot be written either, the batch fails and its source gives it again."""
    spark = batch.sparkSession
    done, spooled = committed(spark, root), waiting(spark, root)
    rows = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        behind = {name: [n for n in spooled if done.get(name, -1) < n < batch_id] for name in sinks}
        lacking = [name for name in sinks if done.get(name, -1) < batch_id]
        failed = []
        # The well ones first: a sink with a backlog may take long.
        for name in sorted(lacking, key=lambda n: len(behind[n])):
            old = [(n, spark.read.schema(batch.schema).parquet(f"{root}/spool/batch_id={n}")) for n in behind[name]]
            if not _take(spark, root, name, sinks[name], [*old, (batch_id, rows)]):
                failed.append(name)
        if failed:
            rows.write.mode("overwrite").parquet(f"{root}/spool/batch_id={batch_id}")
            spark.range(1).select(F.current_timestamp().alias("at")).coalesce(1).write.mode("overwrite").parquet(
                f"{root}/spooled/batch_id={batch_id}")
    finally:
        rows.unpersist()


def catch_up(spark: SparkSession, schema, sinks: Mapping[str, Sink], root: str) -> dict[str, int]:
    """Give lagging sinks what waits for them, outside the stream; the lag that is left. ``schema`` is
    that of the stream. Not to run beside the stream on the same root."""
    done, spooled = committed(spark, root), waiting(spark, root)
    for name, sink in sinks.items():
        old = [n for n in spooled if n > done.get(name, -1)]
        _take(spark, root, name, sink, [(n, spark.read.schema(schema).parquet(f"{root}/spool/batch_id={n}")) for n in old])
    return lag(spark, root, sinks)


def run_fan_out(
    source: DataFrame, sinks: Mapping[str, Sink], root: str, checkpoint: str, *, available_now: bool = False, every: str = "20 seconds"
) -> StreamingQuery:
    """Start the job. ``root`` holds its commits and its spool."""
    if not sinks or any(not name or set(name) & set("/={}*?[]\\ ") for name in sinks):
        raise ValueError("sinks need names that can be folder names")
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    writer = source.writeStream.foreachBatch(lambda df, n: fan_out_batch(df, n, sinks, root))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
