"""Progress of running queries, written beside the run log by a listener, and read as component rows."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from roadpulse.schemas import METRIC
from roadpulse.sources.tables import table_or_empty

# Of each query the last so many triggers are kept, one row each.
SLOTS = 256
DELAYED_SECONDS = 180
PROGRESS = (
    "component string, run_id string, batch_id long, at timestamp, rows_read long, rows_per_second double, rows_done_per_second double, "
    "batch_ms long, state_rows long, state_bytes long, late_rows long, watermark timestamp, newest_event timestamp, error string, "
    "query_id string, slot int"
)
_ENDED = SLOTS  # the slot of a query's end


class ProgressLog(StreamingQueryListener):
    """Writes one row per trigger below ``root/progress``. A failed write loses that row only; it never
    reaches the query. ``queries`` restricts it to some names; all queries of a session else."""

    def __init__(self, spark: SparkSession, root: str, queries: set[str] | None = None):
        super().__init__()
        self.spark, self.root, self.queries = spark, root, queries
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name or str(event.id)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        states = p.stateOperators or []
        seconds = lambda key: _time((p.eventTime or {}).get(key))
        self._write(name, str(p.id), p.batchId % SLOTS, (
            name, str(p.runId), p.batchId, _time(p.timestamp), p.numInputRows, _number(p.inputRowsPerSecond),
            _number(p.processedRowsPerSecond), p.batchDuration, sum(s.numRowsTotal for s in states),
            sum(s.memoryUsedBytes for s in states), sum(s.numRowsDroppedByWatermark for s in states),
            seconds("watermark"), seconds("max"), None))

    def onQueryTerminated(self, event) -> None:
        name = self.names.pop(str(event.id), str(event.id))
        error = event.exception.splitlines()[0][:500] if event.exception else None
        self._write(name, str(event.id), _ENDED, (
            name, str(event.runId), None, datetime.now(timezone.utc), *[None] * 9, error or "ended"))

    def _write(self, name: str, query_id: str, slot: int, row: tuple) -> None:
        if self.queries is not None and name not in self.queries:
            return
        schema = ", ".join(PROGRESS.split(", ")[:-2])
        try:
            self.spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(
                f"{self.root}/progress/query_id={query_id}/slot={slot}")
        except Exception:
            logging.getLogger(__name__).exception("progress of %s not written", name)


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


def _number(value) -> float | None:
    """None where Spark has no rate yet."""
    return float(value) if value is not None and abs(float(value)) < float("inf") else None


def read_progress(spark: SparkSession, roots: list[str]) -> DataFrame:
    """All kept triggers of all queries, over the roots that they log to."""
    found = [table_or_empty(spark, f"{r}/progress", PROGRESS) for r in dict.fromkeys(roots)]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.drop("slot")


def component_rows(progress: DataFrame, now: Column, *, files: DataFrame | None = None) -> DataFrame:
    """Rows as ``operations.component_metrics`` takes them, one per kept trigger in the order of time:
    state, delay and load of each running query. ``files`` (table, modified, size) adds a row per table."""
    ended = F.col("error").isNotNull()
    lag = now.cast("double") - F.col("at").cast("double")
    behind = F.col("at").cast("double") - F.col("newest_event").cast("double")
    metric = lambda name, value, unit: F.struct(
        F.lit(name).alias("name"), value.cast("string").alias("value"), F.lit(None).cast("string").alias("human"), F.lit(unit).alias("unit"))
    metrics = F.array(
        metric("memoria", F.col("state_bytes"), "bytes"), metric("filas", F.col("rows_read"), "count"),
        metric("estado", F.col("state_rows"), "count"), metric("retraso", behind, "seconds"), metric("tardios", F.col("late_rows"), "count"))
    status = (F.when(F.col("error") == "ended", "stopped").when(ended, "error").when(lag > DELAYED_SECONDS, "delayed").otherwise("ok"))
    rows = progress.select(
        "component", status.alias("status"), F.lit("stream").alias("category"), F.lit(None).cast("string").alias("human_lag"),
        lag.alias("lag_seconds"),
        # The share of the time that the query works: rows that arrive over rows it could do.
        (100 * F.col("rows_per_second") / F.nullif("rows_done_per_second", F.lit(0.0))).alias("usage_percent"),
        metrics.cast(f"array<{METRIC.simpleString()}>").alias("metrics"),
        # A query's end comes after its last trigger.
        (F.unix_micros("at") * 2 + ended.cast("int")).alias("ord"),
    )
    if files is None:
        return rows
    size = F.array(metric("tamano", F.sum("size"), "bytes"))
    tables = files.groupBy(F.col("table").alias("component")).agg(
        size.cast(f"array<{METRIC.simpleString()}>").alias("metrics"),
        (F.unix_micros(F.max("modified")) * 2).alias("ord"), F.max("modified").cast("double").alias("_at"))
    lag = now.cast("double") - F.col("_at")
    return rows.unionByName(tables.select(
        "component", F.when(lag > DELAYED_SECONDS, "stale").otherwise("ok").alias("status"), F.lit("table").alias("category"),
        F.lit(None).cast("string").alias("human_lag"), lag.alias("lag_seconds"), F.lit(None).cast("double").alias("usage_percent"),
        "metrics", "ord"))
