"""Stored predictions against what was observed, as a stream.

Closed minutes and predictions are joined as they come. Both sides have a watermark, so a pair waits
for its partner only as long as one may still come; a minute that nobody predicted is stored without
a prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions.aggregates import last_rows
from roadpulse.sources.streams import MAX_FILE_AGE
from roadpulse.sources.tables import table_or_empty
from roadpulse.streaming.merged import WATERMARK

# Predictions kept per target minute.
KEEP = 12
PREDICTIONS = "region_name string, target_ts timestamp, generated_at timestamp, value double"
PAIRS = "region_name string, minute timestamp, observed double, generated_at timestamp, value double, absolute_error double"


def prediction_stream(spark: SparkSession, folder: str, *, max_files: int | None = None) -> DataFrame:
    """Predictions (``PREDICTIONS``) that ``scoring_job.store_predictions`` adds to a folder."""
    reader = spark.readStream.schema(PREDICTIONS).option("maxFileAge", MAX_FILE_AGE)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    return reader.parquet(folder)


def observed_against_predicted(events: DataFrame, predictions: DataFrame, *, watermark: str = WATERMARK) -> DataFrame:
    """Every closed minute of a region with each prediction of it, or with none."""
    closed = (
        events.withWatermark("event_ts", watermark)
        .groupBy(F.window("event_ts", "1 minute").alias("w"), "region_name").agg(F.sum("total_vehicles").cast("double").alias("observed"))
        .select(F.window_time("w").alias("observed_ts"), F.col("w.start").alias("minute"), F.col("region_name").alias("region"), "observed")
    )
    made = predictions.where(F.col("target_ts").isNotNull() & F.col("value").isNotNull()).withWatermark("target_ts", watermark)
    # A target is the start of its minute.
    inside = (F.col("observed_ts") >= F.col("target_ts")) & (F.col("observed_ts") < F.col("target_ts") + F.expr("interval 1 minute"))
    joined = closed.join(made, (F.col("region") == F.col("region_name")) & inside, "left_outer")
    return joined.select(
        F.col("region").alias("region_name"), "minute", "observed", "generated_at", "value",
        F.abs(F.col("observed") - F.col("value")).alias("absolute_error"))


def run_prediction_errors(
    events: DataFrame, predictions: DataFrame, root: str, checkpoint: str, *, watermark: str = WATERMARK, available_now: bool = False
) -> StreamingQuery:
    """Store the pairs by day; the file sink's log makes each count once."""
    rows = observed_against_predicted(events, predictions, watermark=watermark).withColumn("dt", F.date_format("minute", "yyyyMMdd"))
    writer = rows.writeStream.outputMode("append").format("parquet").partitionBy("dt").option("path", root)
    trigger = {"availableNow": True} if available_now else {"processingTime": "20 seconds"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_errors(spark: SparkSession, root: str) -> DataFrame:
    return table_or_empty(spark, root, PAIRS)


def worst_stored(pairs: DataFrame, by: Sequence[str] = ("region_name",), *, keep: int = KEEP) -> DataFrame:
    """``scoring.worst_prediction`` from stored pairs: of the last ``keep`` predictions of a minute the
    one that missed most, the earliest on ties."""
    kept = last_rows(pairs.where(F.col("value").isNotNull()), [*by, "minute"], [F.desc("generated_at")], keep)
    worst = last_rows(kept, [*by, "minute"], [F.desc("absolute_error"), F.asc("generated_at")], 1)
    return worst.select(*by, "minute", F.col("value").alias("worst_prediction"), "observed", "absolute_error")


def unpredicted(pairs: DataFrame) -> DataFrame:
    """Observed minutes without any prediction."""
    return pairs.where(F.col("value").isNull()).select("region_name", "minute", "observed")
