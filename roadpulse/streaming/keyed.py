"""Running statistics in keyed state: one processor per road instead of one table delta per batch.

State lives in RocksDB and is checkpointed with the query. A road that no event names for a given
time is forgotten; should it come back, it starts anew. Each trigger stores only what it changed.
The other form (``state``) never forgets and needs no Python worker; both give the same statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from roadpulse.functions.measures import round_half_even
from roadpulse.schemas import META_FIELDS, STATE_DIRECTION, STATE_META, STATE_STAT
from roadpulse.sources.tables import table_or_empty

SILENT = timedelta(days=30)
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Timers on the clock would ask for empty triggers without end, also after all data is read. So a
    # road is forgotten by the first trigger with any event after its time.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
OVERALL = -1  # the hour that stands for the whole road
_META = ", ".join(f"{n} string" for n in META_FIELDS)
_PARTS = f"road_id string, hour int, minute long, direction string, total double, counted long, arrival long, {_META}"
_CHANGES = f"road_id string, kind string, hour int, direction string, count long, mean double, m2 double, {_META}"
_STORED = _CHANGES + ", version long"
_FOLDED = _CHANGES + ", version long, upto long"
_SCHEMAS = {"stats": STATE_STAT, "directions": STATE_DIRECTION, "meta": STATE_META}


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums per road, minute and direction of each slice of rows, so that a road with a third of all
    events sends few rows to its one processor. Descriptors are those of the first arrival."""
    keys = ["road_id", "hour", "minute", "direction"]
    for rows in batches:
        rows = rows.sort_values(["arrival", *META_FIELDS], kind="stable")
        grouped = rows.groupby(keys, dropna=False, sort=False)
        sums = grouped[["total", "counted"]].sum().reset_index()
        first = rows.drop_duplicates(keys)[[*keys, "arrival", *META_FIELDS]].reset_index(drop=True)
        out = pd.concat([sums, first[["arrival", *META_FIELDS]]], axis=1)
        out["direction"] = out["direction"].astype(object).where(out["direction"].notna(), None)
        yield out[[c.split()[0] for c in _PARTS.split(", ")]]


class RoadProcessor(StatefulProcessor):
    """Statistics, direction counts and descriptors of one road. ``seen`` lives as long as a road may
    be silent; the one timer of a road looks whether it is still there."""

    def __init__(self, silent_ms: int):
        self.silent_ms = silent_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long", self.silent_ms)
        self.meta = handle.getValueState("meta", _META)
        self.stats = handle.getMapState("stats", "hour int", "count long, mean double, m2 double")
        self.directions = handle.getMapState("directions", "direction string", "count long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (road,) = key
        totals: dict[tuple[int, int], float] = {}
        directions: dict[str, int] = {}
        first = None
        for r in rows:
            totals[r.hour, r.minute] = totals.get((r.hour, r.minute), 0.0) + r.total
            if r.direction is not None:
                directions[r.direction] = directions.get(r.direction, 0) + r.counted
            own = (r.arrival, *[r[n] for n in META_FIELDS])
            first = own if first is None else min(first, own)
        now = timerValues.getCurrentProcessingTimeInMs()
        if not self.seen.exists():
            if self.meta.exists():
                self._forget()
                yield _change(road, "gone")
            self.handle.registerTimer(now + self.silent_ms)
        self.seen.update((now,))

        held = self.meta.get() if self.meta.exists() else ("",) * len(META_FIELDS)
        meta = tuple(a or b for a, b in zip(held, first[1:], strict=True))
        self.meta.update(meta)
        yield _change(road, "meta", meta=meta)
        for hour in sorted({h for h, _ in totals} | {OVERALL}):
            values = [max(v, 0.0) for (h, _), v in totals.items() if hour in (h, OVERALL)]
            merged = _merged(self.stats.getValue((hour,)) if self.stats.containsKey((hour,)) else (0, 0.0, 0.0), values)
            self.stats.updateValue((hour,), merged)
            yield _change(road, "stats", hour=None if hour == OVERALL else hour, numbers=merged)
        for direction, counted in directions.items():
            before = self.directions.getValue((direction,))[0] if self.directions.containsKey((direction,)) else 0
            self.directions.updateValue((direction,), (before + counted,))
            yield _change(road, "directions", direction=direction, numbers=(before + counted, None, None))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.seen.exists():
            self.handle.registerTimer(self.seen.get()[0] + self.silent_ms)
        elif self.meta.exists():
            self._forget()
            yield _change(key[0], "gone")

    def _forget(self) -> None:
        for held in (self.meta, self.stats, self.directions):
            held.clear()

    def close(self) -> None:
        pass


def _merged(held: tuple, values: list[float]) -> tuple[int, float, float]:
    """Count, mean and squared deviations of the held part and of new values together."""
    n = len(values)
    mean = sum(values) / n
    m2 = sum((v - mean) ** 2 for v in values)
    count, apart = held[0] + n, mean - held[1]
    return count, held[1] + apart * n / count, held[2] + m2 + apart * apart * held[0] * n / count


def _change(road: str, kind: str, *, hour=None, direction=None, numbers=(None, None, None), meta=(None,) * len(META_FIELDS)) -> Row:
    return Row(*[c.split()[0] for c in _CHANGES.split(", ")])(road, kind, hour, direction, *numbers, *meta)


def road_changes(events: DataFrame, *, silent: timedelta = SILENT) -> DataFrame:
    """What each trigger changes, of a stream of normalised events. One observation is the total of
    one road in one minute of one batch, as in ``runtime.batch_stats``."""
    milliseconds = int(silent / timedelta(milliseconds=1))
    if milliseconds < 1:
        raise ValueError("silent must be at least a millisecond")
    parts = events.where(F.col("road_id") != "").select(
        "road_id", F.hour("minute").alias("hour"), F.unix_timestamp("minute").alias("minute"), "direction",
        F.col("vehicle_count").cast("double").alias("total"),
        F.greatest(round_half_even(F.col("vehicle_count")), F.lit(1).cast("bigint")).alias("counted"),
        F.coalesce("arrival", F.lit(-1).cast("bigint")).alias("arrival"),
        *[F.coalesce(f"meta_{n}", F.lit("")).alias(n) for n in META_FIELDS],
    )
    return parts.mapInPandas(_partial, _PARTS).groupBy("road_id").transformWithState(
        RoadProcessor(milliseconds), _CHANGES, "Update", "ProcessingTime")


def run_road_state(
    events: DataFrame, root: str, checkpoint: str, *, silent: timedelta = SILENT, available_now: bool = False
) -> StreamingQuery:
    """Start the query; every trigger's changes land below its number and replace what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/version={batch_id}")

    spark = events.sparkSession
    trigger = {"availableNow": True} if available_now else {"processingTime": "20 seconds"}
    writer = road_changes(events, silent=silent).writeStream.outputMode("update").foreachBatch(write)
    # A query keeps the settings it is started with; the session's own stay.
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _latest(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The newest row of every kind, hour and direction of the roads that are not forgotten, and the
    last version that a fold holds (-1: none)."""
    folded = table_or_empty(spark, f"{root}/folded", _FOLDED)
    last = folded.agg(F.max("upto").alias("m")).first()["m"]
    last = -1 if last is None else last
    rows = folded.where(F.col("upto") == last).drop("upto").unionByName(
        table_or_empty(spark, f"{root}/changes", _STORED).where(F.col("version") > last))
    gone = rows.where("kind = 'gone'").groupBy("road_id").agg(F.max("version").alias("_gone"))
    # What the version that forgets a road holds of it besides comes after the forgetting.
    alive = rows.where("kind <> 'gone'").join(gone, "road_id", "left").where(F.col("_gone").isNull() | (F.col("version") >= F.col("_gone")))
    values = F.struct("count", "mean", "m2", *META_FIELDS)
    return alive.groupBy("road_id", "kind", "hour", "direction").agg(
        F.max_by(values, "version").alias("v"), F.max("version").alias("version")).select(
        "road_id", "kind", "hour", "direction", "v.*", "version"), last


def read_road_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the state (stats, directions, meta) in the columns of ``state.read_state``."""
    return _latest(spark, root)[0].where(F.col("kind") == name).select(*_SCHEMAS[name].fieldNames())


def fold_road_state(spark: SparkSession, root: str) -> None:
    """Write the newest rows beside the changes, numbered by the last version in them; readers then
    take the versions after it only. What a fold replaces may be removed at any time."""
    latest, last = _latest(spark, root)
    newest = table_or_empty(spark, f"{root}/changes", _STORED).agg(F.max("version").alias("m")).first()["m"]
    if newest is not None and newest > last:
        latest.where(F.col("version") <= newest).write.mode("overwrite").parquet(f"{root}/folded/upto={newest}")
