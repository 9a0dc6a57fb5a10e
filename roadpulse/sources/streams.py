"""Event streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import RAW_EVENT

# Files older than this, against the newest one, are not looked at. Longer than any outage.
MAX_FILE_AGE = "3650d"
# Spooled events sort after those of every live partition.
SPOOL_PARTITION = (1 << 15) - 1


def kafka_events(
    spark: SparkSession, servers: str, topics: Sequence[str], *, max_per_trigger: int | None = None
) -> DataFrame:
    """All topics from their earliest offset. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        "topic", "partition", "offset", F.col("timestamp").alias("ingest_ts"),
        F.col("value").cast("string").alias("value"),
    )


def landed_events(
    spark: SparkSession, folder: str, *, form: str = "json", max_files: int | None = None
) -> DataFrame:
    """The same columns from files that land in a folder (JSON lines or parquet)."""
    reader = spark.readStream.schema(RAW_EVENT).option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(form).load(folder)


def spooled_events(
    spark: SparkSession, folder: str, archive: str, *, topic: str = "spool", max_files: int = 500
) -> DataFrame:
    """Events that could not be sent, one JSON file each, oldest first; read files move to ``archive``.

    Their partition is one no live event has. The arrival number is the file's modification
    time in milliseconds, seconds in the high bits, and six bits of its name for equal times.
    """
    changed = F.unix_millis("_metadata.file_modification_time")
    tie = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(64))
    number = F.shiftleft((changed / 1000).cast("bigint"), 16) + F.shiftleft(changed % 1000, 6) + tie
    return (
        spark.readStream.format("text").option("wholetext", True).option("maxFileAge", MAX_FILE_AGE)
        .option("maxFilesPerTrigger", max_files).option("latestFirst", False)
        .option("cleanSource", "archive").option("sourceArchiveDir", archive)
        .load(folder)
        .select(
            F.lit(topic).alias("topic"), F.lit(SPOOL_PARTITION).alias("partition"), number.alias("offset"),
            F.col("_metadata.file_modification_time").alias("ingest_ts"),
            "value",
        )
    )


def with_replay(live: DataFrame, spooled: DataFrame, *, within: str = "1 hour") -> DataFrame:
    """Live and replayed payloads, each event id once within ``within`` of its first reading.

    The watermark runs on the time of reading, not on the age of an event: what is replayed
    after an outage of any length is never late.
    """
    both = live.unionByName(spooled).withColumn(
        "event_id", F.try_variant_get(F.try_parse_json("value"), "$.event_id", "string")
    )
    # Payloads without an id (broken ones) are told apart by their text.
    key = F.coalesce("event_id", F.sha2("value", 256))
    return (
        both.withColumns({"event_id": key, "read_ts": F.current_timestamp()}).withWatermark("read_ts", within)
        .dropDuplicatesWithinWatermark(["event_id"]).drop("event_id", "read_ts")
    )


def gold_stream(spark: SparkSession, folder: str, schema, *, form: str = "parquet", max_files: int | None = None) -> DataFrame:
    """New files of a table, each once; the checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.format(form).load(folder)
