"""The running-profile state as tables: one delta per batch, merged on read.

A batch appends its (count, mean, m2) rows, direction counts and descriptors under its
own id; writing it again replaces it, so a replayed batch counts once. Merging is
associative, so a compaction may fold any prefix of the batches into a snapshot. No
batch rewrites the whole state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators import runtime
from roadpulse.schemas import META_FIELDS, STATE_DIRECTION, STATE_META, STATE_STAT
from roadpulse.sources.tables import failover_union, table_or_empty

_TABLES = {"stats": STATE_STAT, "directions": STATE_DIRECTION, "meta": STATE_META}


def _merge(name: str, parts: DataFrame) -> DataFrame:
    if name == "stats":
        return runtime.merge_stats(parts)
    if name == "directions":
        return runtime.merge_directions(parts)
    return runtime.merge_metadata(parts, "batch_id")


def batch_state(events: DataFrame) -> dict[str, DataFrame]:
    """What one batch of normalised events adds to the state."""
    return {
        "stats": runtime.batch_stats(runtime.minute_totals(events)),
        "directions": runtime.direction_counts(events),
        "meta": runtime.batch_metadata(events),
    }


def write_delta(delta: dict[str, DataFrame], root: str, batch_id: int) -> None:
    for name, df in delta.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}/delta/batch_id={batch_id}")


def _with(schema: T.StructType, column: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(column, T.LongType())])


def _parts(spark: SparkSession, root: str | Sequence[str], name: str, upto: int | None) -> tuple[DataFrame, int]:
    """Latest snapshot plus later deltas, and the last batch the snapshot holds (-1: none).
    Snapshots stand below the first root; a batch's delta is read from the first root that has it."""
    schema, roots = _TABLES[name], [root] if isinstance(root, str) else list(root)
    snapshots = table_or_empty(spark, f"{roots[0]}/{name}/snapshot", _with(schema, "upto"))
    if upto is not None:
        snapshots = snapshots.where(F.col("upto") <= upto)
    last = snapshots.agg(F.max("upto").alias("m")).first()["m"]
    last = -1 if last is None else last
    deltas = [table_or_empty(spark, f"{r}/{name}/delta", _with(schema, "batch_id")).where(F.col("batch_id") > last) for r in roots]
    deltas = deltas[0] if len(deltas) == 1 else failover_union(deltas)
    if upto is not None:
        deltas = deltas.where(F.col("batch_id") <= upto)
    snapshot = snapshots.where(F.col("upto") == last).withColumnRenamed("upto", "batch_id")
    return snapshot.unionByName(deltas), last


def read_state(spark: SparkSession, root: str | Sequence[str], name: str, *, upto: int | None = None) -> DataFrame:
    """The merged state after batch ``upto`` (default: the last); empty where nothing was written.
    With several roots, those of a job with a failover root."""
    parts, _ = _parts(spark, root, name, upto)
    return _merge(name, parts.transform(_tolerant, name))


def _tolerant(parts: DataFrame, name: str) -> DataFrame:
    """Missing numbers count as 0, missing texts as empty."""
    numbers = {"stats": ["count", "mean", "m2"], "directions": ["count"], "meta": []}[name]
    texts = list(META_FIELDS) if name == "meta" else []
    return parts.fillna(0, subset=numbers).fillna("", subset=texts) if texts else parts.fillna(0, subset=numbers)


def compact(spark: SparkSession, root: str | Sequence[str], upto: int) -> None:
    """Fold the deltas up to ``upto`` into one snapshot per table, below the first root."""
    first = root if isinstance(root, str) else root[0]
    for name in _TABLES:
        parts, last = _parts(spark, root, name, upto)
        if upto > last:
            _merge(name, parts.transform(_tolerant, name)).write.mode("overwrite").parquet(
                f"{first}/{name}/snapshot/upto={upto}"
            )


def running_profiles(spark: SparkSession, root: str | Sequence[str], *, min_observations: int = 3) -> dict[str, DataFrame]:
    """The running profile tables of the stored state."""
    stats = read_state(spark, root, "stats")
    roads = runtime.runtime_road_profile(stats, read_state(spark, root, "meta"))
    return {
        "road_profile": roads,
        "road_hour": runtime.runtime_hours(stats, min_observations=min_observations),
        "road_mix": runtime.runtime_direction_mix(read_state(spark, root, "directions")).withColumn("dim", F.lit("direction")),
        "region_profile": runtime.runtime_region_profile(roads),
    }
