"""Stream job: events to silver, gold, running state and a run log, batch by batch."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators import gold as gold_ops
from roadpulse.operators.events import normalise_events, parsed_payloads, variant_fields
from roadpulse.schemas import FOLDED_GOLD, RUN_LOG, STORED_GOLD
from roadpulse.sinks import writers
from roadpulse.sources.tables import read_gold_window, table_or_empty
from roadpulse.streaming import dedupe, minutes, state

TRIGGER = "20 seconds"
# A minute is closed when its end lies this long before the newest event.
LATE_MINUTES = 10
# An event dated later than its reading, give or take this much, moves the newest event no further.
AHEAD_MINUTES = 1
# The newest event time stands in one of so many slots, by batch id; so finding it costs the
# same after a day and after a year.
SLOTS = 64
MARK = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("newest_event_ts", T.TimestampType()), T.StructField("slot", T.IntegerType()),
])
_LOG = T.StructType([
    *RUN_LOG.fields, T.StructField("max_event_ts", T.TimestampType()), T.StructField("closed_upto", T.TimestampType()),
    T.StructField("repeated_events", T.LongType()),
])
FOLDED_LOG = T.StructType([*_LOG.fields, T.StructField("source_root", T.IntegerType()), T.StructField("upto", T.LongType())])


@dataclass(frozen=True)
class Layout:
    """Where a stream job writes. A batch goes wholly to ``root``, or, when that cannot take it,
    wholly to ``failover``; readers take each batch from one of them."""

    root: str
    failover: str | None = None
    component: str = "pipeline"

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @property
    def roots(self) -> list[str]:
        return [self.root, self.failover] if self.failover else [self.root]


def process_batch(batch: DataFrame, batch_id: int, layout: Layout) -> None:
    """Everything one micro-batch writes. Running it again with the same id changes nothing; an event
    whose id an earlier batch holds counts no second time, whenever that was."""
    # Parsed once; read by the writes below. A lost executor's part is computed again from the source.
    parsed = parsed_payloads(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        events = normalise_events(parsed.where("is_object"), field=variant_fields())
        dead = parsed.where(~F.col("is_object")).select(*batch.columns)
        log = run_log(batch.sparkSession, layout).where(F.col("batch_id") < batch_id).persist(StorageLevel.MEMORY_AND_DISK)
        hours = dedupe.ids_per_hour(events)
        gone = dedupe.repeats(events, layout, log, hours).persist(StorageLevel.MEMORY_AND_DISK)
        repeated = gone.count()
        if repeated:
            events = dedupe.without(events, gone)
        # Also before the first write: what fails here is the source, not the root.
        read_by = F.lit(datetime.now(timezone.utc) + timedelta(minutes=AHEAD_MINUTES))
        own = events.agg(F.max(F.least("event_ts", read_by)).alias("newest"), F.count(F.lit(1)).alias("n")).first()
        seen = newest_event(batch.sparkSession, layout, before=batch_id)

        def write(root: str, failover: bool) -> None:
            _write_all(events, dead, batch_id, root, failover, layout, own, seen, hours, repeated, log)

        writers.write_with_failover(write, layout.root, layout.failover)
        gone.unpersist()
        log.unpersist()
    finally:
        parsed.unpersist()


def _write_all(events, dead, batch_id: int, root: str, failover: bool, layout: Layout, own, seen: datetime | None, hours, repeated: int, log) -> None:
    """All tables of a batch below one root; the run log comes last and says it is complete."""
    dead.write.mode("overwrite").parquet(f"{root}/dead_letters/batch_id={batch_id}")
    writers.write_silver(events, f"{root}/silver", batch_id)
    dedupe.write_ids(events, root, batch_id, hours)
    newest = max((t for t in (own.newest, seen) if t is not None), default=None)
    rows = gold_ops.gold_all(events).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counted = _counter("gold")
        writers.write_gold(rows.observe(counted, F.count(F.lit(1)).alias("n")), f"{root}/gold", batch_id, failover=failover)
        closed = minutes.close(rows, layout, root, batch_id, newest, log, failover=failover)
    finally:
        rows.unpersist()
    state.write_delta(state.batch_state(events), f"{root}/state", batch_id)

    spark = events.sparkSession
    mark = spark.createDataFrame([(batch_id, newest)], T.StructType(MARK.fields[:2]))
    mark.coalesce(1).write.mode("overwrite").parquet(f"{root}/high_water/slot={batch_id % SLOTS}")
    entry = events.agg(F.array_sort(F.collect_set("topic")).alias("topics")).select(
        F.lit(layout.component).alias("component"), F.lit(time.time()).alias("last_flush_time"),
        F.lit(own.n).cast("bigint").alias("total_events"), F.lit(counted.get["n"]).cast("bigint").alias("gold_records"),
        "topics", F.lit(failover).alias("writer_failover_active"), F.lit(own.newest).cast("timestamp").alias("max_event_ts"),
        F.lit(closed).cast("timestamp").alias("closed_upto"), F.lit(repeated).cast("bigint").alias("repeated_events"),
    )
    writers.write_run_log(entry, f"{root}/run_log", batch_id)


def _counter(name: str):
    """Counts the rows of a write as it passes them, so that nothing is read back."""
    from pyspark.sql import Observation

    return Observation(name)


def newest_event(spark: SparkSession, layout: Layout, *, before: int | None = None) -> datetime | None:
    """Newest event time of all batches (of those before one), from at most ``SLOTS`` rows a root.
    Event times count up to the reading of their batch, so a clock that is ahead moves nothing."""
    found = []
    for root in layout.roots:
        marks = table_or_empty(spark, f"{root}/high_water", MARK)
        marks = marks if before is None else marks.where(F.col("batch") < before)
        found.append(marks.agg(F.max("newest_event_ts").alias("m")).first()["m"])
    return max((t for t in found if t is not None), default=None)


def run_log(spark: SparkSession, layout: Layout) -> DataFrame:
    """One row per complete batch and the number of the root that holds it: the first whose log has
    the batch. Folded entries stand in one table, so only the batches since are listed."""
    parts = [table_or_empty(spark, f"{root}/run_log", _LOG).withColumn("source_root", F.lit(n)) for n, root in enumerate(layout.roots)]
    folded = table_or_empty(spark, layout.path("run_log_folded"), FOLDED_LOG)
    latest = folded.agg(F.max("upto").alias("m")).first()["m"]
    every = folded.where(F.col("upto") == F.lit(-1 if latest is None else latest)).drop("upto")
    for part in parts:
        every = every.unionByName(part.select(*every.columns))
    first = every.groupBy("batch_id").agg(F.min("source_root").alias("source_root"))
    return every.join(first, ["batch_id", "source_root"], "left_semi").dropDuplicates(["batch_id"])


def complete_batches(spark: SparkSession, layout: Layout) -> DataFrame:
    return run_log(spark, layout).select("batch_id", "source_root")


def read_batches(
    spark: SparkSession, layout: Layout, table: str, schema: T.StructType, *, minutes: int = 0,
    newest: datetime | None = None, log: DataFrame | None = None,
) -> DataFrame:
    """A batch table (gold, gold_late, minutes) over all roots: every complete batch (of ``log``, if
    given) once, from the root that completed it. ``minutes`` reads only that long before ``newest`` (the
    newest event, if not given), and lists only those hours."""
    newest = newest or newest_event(spark, layout) if minutes > 0 else None
    parts = []
    for n, root in enumerate(layout.roots):
        path = f"{root}/{table}"
        rows = read_gold_window(spark, path, minutes, newest, schema=schema) if minutes > 0 else table_or_empty(spark, path, schema)
        parts.append(rows.withColumn("source_root", F.lit(n)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    complete = complete_batches(spark, layout) if log is None else log
    return rows.join(complete, ["batch_id", "source_root"], "left_semi").drop("source_root")


def read_folded(spark: SparkSession, layout: Layout, table: str = "gold_folded", *, minutes: int = 0) -> DataFrame:
    """The hours that the maintenance job folded, each in its latest form."""
    path = layout.path(table)
    if minutes > 0:
        rows = read_gold_window(spark, path, minutes, newest_event(spark, layout), schema=FOLDED_GOLD)
    else:
        rows = table_or_empty(spark, path, FOLDED_GOLD)
    latest = rows.groupBy("dt", "hour").agg(F.max("upto").alias("upto"))
    return rows.join(latest, ["dt", "hour", "upto"], "left_semi")


def unfolded(rows: DataFrame, folded: DataFrame) -> DataFrame:
    """Rows of the batches that the fold of their hour does not hold yet."""
    upto = folded.select("dt", "hour", F.col("upto").alias("_upto")).distinct()
    return rows.join(upto, ["dt", "hour"], "left").where(F.col("_upto").isNull() | (F.col("batch_id") > F.col("_upto"))).drop("_upto")


def read_gold(spark: SparkSession, layout: Layout, *, minutes: int = 0) -> DataFrame:
    """Gold rows of all batches: folded hours, and the partial rows of the batches after the fold.
    ``gold.merge_gold_partials`` makes one row per key and minute of them."""
    folded = read_folded(spark, layout, minutes=minutes)
    fresh = unfolded(read_batches(spark, layout, "gold", STORED_GOLD, minutes=minutes), folded)
    return fresh.unionByName(folded.withColumnRenamed("upto", "batch_id"))


def run_medallion(
    source: DataFrame, layout: Layout, checkpoint: str, *, available_now: bool = False, every: str = TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Start the job. The checkpoint and the per-batch paths make every event count once. ``name`` is
    the query's, and what ``progress.ProgressLog`` calls it."""
    writer = source.writeStream.foreachBatch(lambda df, i: process_batch(df, i, layout)).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.queryName(name) if name else writer
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()
