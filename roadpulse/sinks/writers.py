"""Writers. Everything a batch writes is keyed by its id, so a retry replaces it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.events import silver_keys

# A write of one frame to one root; tells whether the rows carry the failover flag.
Write = Callable[[str, bool], None]


def write_silver(events: DataFrame, root: str, batch_id: int) -> None:
    """Unmodified payloads (column ``value`` of normalised events) under
    ``dt / hour / batch_id / region_slug``.

    Rebalancing writes few files per partition and splits a hot region.
    """
    rows = silver_keys(events).select("topic", "partition", "offset", "ingest_ts", "value", "region_slug", "dt", "hour")
    _write_batch(rows, root, batch_id, ["region_slug"])


def _write_batch(df: DataFrame, path: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """Day and hour come first, so that readers list what they need however many batches there
    are. Only this batch's own folders are replaced."""
    folders = ["dt", "hour", "batch_id", *by]
    rows = df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", *[F.col(c) for c in ("dt", "hour", *by)])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def write_gold(gold: DataFrame, root: str, batch_id: int, *, failover: bool = False) -> None:
    """Gold rows under ``dt / hour / batch_id``."""
    rows = gold.drop("batch_id").withColumns({
        "writer_failover_active": F.lit(failover),
        "dt": F.date_format("event_timestamp", "yyyyMMdd"),
        "hour": F.date_format("event_timestamp", "HH"),
    })
    _write_batch(rows, root, batch_id)


def write_with_failover(write: Write, primary: str, secondary: str | None = None) -> bool:
    """Write to ``primary``; if that fails, to ``secondary``. True when the failover took it."""
    try:
        write(primary, False)
        return False
    except Exception:
        if not secondary:
            raise
        write(secondary, True)
        return True


def fan_out(df: DataFrame, writes: Sequence[Callable[[DataFrame], None]]) -> None:
    """One computed frame to several sinks. The cache is rebuilt if an executor goes."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for write in writes:
            write(df)
    finally:
        df.unpersist()


def write_run_log(entry: DataFrame, root: str, batch_id: int) -> None:
    entry.coalesce(1).write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")


def write_clean_counts(clean: DataFrame, path: str, *, form: str = "parquet", by: Sequence[str] = ()) -> None:
    """``by`` names the columns that become folders; few files each."""
    writer = (clean.hint("rebalance", *[F.col(c) for c in by]) if by else clean).write.mode("overwrite")
    writer = writer.partitionBy(*by) if by else writer
    if form == "csv":
        writer.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    else:
        writer.parquet(path)
