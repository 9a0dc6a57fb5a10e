"""Every event id once, however long ago its first reading was.

Each batch stores the ids of its events by the hour they are dated, and a Bloom filter of them: blocks
of 32,768 bits, as many as the ids of that hour need. A repeated event has the time of its first
reading, so a later batch tests its ids against the filters of its own hours only; just the ids that
may have been seen meet the stored ids, exactly. Nothing is held in memory between batches.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.sources.tables import LISTED_HOURS

if TYPE_CHECKING:
    from roadpulse.streaming.medallion import Layout

BLOCK_BITS = 32_768
BITS_PER_ID = 12
HASHES = 5
IDS = "event_id string, dt string, hour string, batch_id long"
FILTERS = "blocks int, block int, bits binary, dt string, hour string, batch_id long"


def _hour(events: DataFrame) -> dict[str, Column]:
    return {"dt": F.date_format("event_ts", "yyyyMMdd"), "hour": F.date_format("event_ts", "HH")}


def identified(events: DataFrame) -> DataFrame:
    """event_id, arrival and the hour of the events that have an id; the others are never repeats."""
    named = events.where(F.col("event_id").isNotNull() & (F.col("event_id") != "") & F.col("event_ts").isNotNull())
    return named.select("event_id", "arrival", *[c.alias(n) for n, c in _hour(named).items()])


def ids_per_hour(events: DataFrame) -> dict[tuple[str, str], int]:
    """How many ids a batch has by hour: one short row per hour of the batch."""
    return {(r.dt, r.hour): r["count"] for r in identified(events).groupBy("dt", "hour").count().collect()}


def _places() -> Column:
    """The bits of an id inside its block."""
    return F.array(*[F.pmod(F.xxhash64("event_id", F.lit(n)), F.lit(BLOCK_BITS)).cast("int") for n in range(1, HASHES + 1)])


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("event_id", F.lit(0)), blocks).cast("int")


def write_ids(events: DataFrame, root: str, batch_id: int, hours: Mapping[tuple[str, str], int]) -> None:
    """The ids of a batch and their filters below ``root``, by hour and batch."""
    if not hours:
        return
    spark = events.sparkSession
    ids = identified(events).select("event_id", "dt", "hour").withColumn("batch_id", F.lit(batch_id).cast("bigint"))

    def write(rows: DataFrame, table: str) -> None:
        rows.hint("rebalance", F.col("dt"), F.col("hour")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("dt", "hour", "batch_id").parquet(f"{root}/{table}")

    write(ids, "event_ids")
    sizes = spark.createDataFrame(
        [(dt, hour, -(-n * BITS_PER_ID // BLOCK_BITS)) for (dt, hour), n in hours.items()], "dt string, hour string, blocks int")
    placed = ids.join(sizes, ["dt", "hour"]).withColumn("block", _block(F.col("blocks"))).withColumn("place", F.explode(_places()))
    write(placed.groupBy("blocks", "block", "dt", "hour", "batch_id").agg(F.bitmap_construct_agg("place").alias("bits")), "id_filters")


def _stored(spark: SparkSession, layout: Layout, table: str, schema: str, hours: list[tuple[str, str]], log: DataFrame) -> DataFrame:
    """Rows of these hours from the batches of the log; only the folders of the hours are listed."""
    found = []
    for n, root in enumerate(layout.roots):
        path = f"{root}/{table}"
        folders = "/{" + ",".join(f"dt={dt}/hour={hour}" for dt, hour in hours) + "}" if len(hours) <= LISTED_HOURS else ""
        try:
            rows = spark.read.schema(schema).option("basePath", path).parquet(path + folders)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
            continue
        found.append(rows.withColumn("source_root", F.lit(n)))
    if not found:
        return spark.createDataFrame([], schema)
    rows = reduce(DataFrame.unionByName, found)
    return rows.join(log, ["batch_id", "source_root"], "left_semi").drop("source_root")


def repeats(events: DataFrame, layout: Layout, log: DataFrame, hours: Mapping[tuple[str, str], int]) -> DataFrame:
    """event_id and arrival of the events of a batch that are repeats: of an earlier batch (those in
    the run log ``log``), or of an event of this batch that arrived before."""
    spark, own = events.sparkSession, identified(events)
    first = own.groupBy("event_id").agg(F.min("arrival").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = own.join(first, "event_id").where(F.col("arrival") > F.col("first")).select("event_id", "arrival")
    if not hours:
        return again
    filters = _stored(spark, layout, "id_filters", FILTERS, sorted(hours), log)
    # An hour has few different sizes of filters, one per batch at most.
    sizes = filters.select("dt", "hour", "blocks").distinct()
    asked = own.join(sizes, ["dt", "hour"]).withColumn("block", _block(F.col("blocks")))
    hit = F.forall(_places(), lambda p: _bit(F.col("bits"), p))
    suspects = asked.join(filters.drop("batch_id"), ["dt", "hour", "blocks", "block"]).where(hit).select("event_id", "dt", "hour").distinct()
    seen = suspects.join(_stored(spark, layout, "event_ids", IDS, sorted(hours), log), ["event_id", "dt", "hour"], "left_semi")
    return own.join(seen, ["event_id", "dt", "hour"], "left_semi").select("event_id", "arrival").unionByName(again).distinct()


def _bit(bits: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set, counted from the lowest bit of its first byte on."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), place.bitwiseAND(F.lit(7)))) != 0


def without(events: DataFrame, gone: DataFrame) -> DataFrame:
    return events.join(gone, ["event_id", "arrival"], "left_anti")
