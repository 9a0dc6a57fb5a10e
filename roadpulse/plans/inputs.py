"""Intermediate tables the registered queries share, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators import analytics as A
from roadpulse.operators import cleaning, gold, profiles, records, runtime
from roadpulse.operators.events import normalise_events
from roadpulse.sources import driver_tables as src

# Long history of the deployed dashboard, in minutes.
WINDOW = 180
# The derived counts are thin, so hours need few observations.
RUNTIME_MIN_OBSERVATIONS = 3


def events(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_events(src.traffic_events(spark, sf))


def gold_rows(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_all(events(spark, sf))


def gold_partials(spark: SparkSession, sf: str) -> DataFrame:
    return gold.gold_all(events(spark, sf), batch=["batch_id"])


def live(spark: SparkSession, sf: str) -> DataFrame:
    """Records of the gold table; its own roll-ups need no density backfill."""
    return records.normalise_gold(gold_rows(spark, sf), backfill=False)


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared counts. The typed source has nothing for the text cleaning to do but map directions."""
    return cleaning.prepare_counts(cleaning.clean_counts(src.traffic_counts(spark, sf)))


def roads(spark: SparkSession, sf: str) -> DataFrame:
    return profiles.road_profile(counts(spark, sf))


def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    return runtime.batch_stats(runtime.minute_totals(events(spark, sf)))


def run_roads(spark: SparkSession, sf: str) -> DataFrame:
    e = events(spark, sf)
    return runtime.runtime_road_profile(run_stats(spark, sf), runtime.batch_metadata(e))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """One scoring request per customer: by id, by padded name, or for an unknown road."""
    key = F.col("c_custkey")
    road = F.concat(F.lit("a"), key % 50)
    return src.load(spark, sf, "customer").select(
        key.alias("request_id"),
        F.when(key % 11 == 0, F.concat(F.lit("road:none-"), key))
        .when(key % 2 == 0, F.concat(F.lit("road:"), road)).alias("road_id"),
        F.when((key % 2 == 1) & (key % 11 != 0), F.concat(F.lit("  "), F.upper(road), F.lit(" "))).alias("road_name"),
        (key % 24).cast("int").alias("hour_of_day"),
        F.when(key % 5 == 0, "northbound").when(key % 5 == 1, "WESTBOUND").when(key % 5 == 2, "nowhere").alias("direction"),
        F.element_at(F.array(*[F.lit(x) for x in (0.0, 1.0, 0.5, 2.0)]), (key % 4 + 1).cast("int")).alias("scaling_factor"),
    )


def region_series(spark: SparkSession, sf: str) -> DataFrame:
    """Vehicles per region and minute, gaps filled, from the region rows."""
    rows = records.normalise_gold(gold.gold_region(events(spark, sf)), backfill=False)
    return A.minute_series(rows, ["region_name"])


def region_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Expected flow of a region: the mean baseline of its roads."""
    return runtime.runtime_region_profile(run_roads(spark, sf)).select(
        "region_name", F.col("baseline_rate_per_minute").alias("expected_flow_per_minute")
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Three generations of predictions for every target minute of a region."""
    lead = F.col("lead")
    return region_series(spark, sf).withColumn("lead", F.explode(F.sequence(F.lit(1), F.lit(3)))).select(
        "region_name",
        (F.col("minute") + F.make_dt_interval(mins=lead)).alias("target_ts"),
        F.col("minute").alias("generated_at"),
        (F.col("value") * (1 + lead / F.lit(8.0))).alias("value"),
    )


def last_generation(predicted: DataFrame):
    return predicted.agg(F.max("generated_at").alias("m")).scalar()


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """One flush per batch and topic, stamped with the newest event in it."""
    return events(spark, sf).groupBy(
        F.concat(F.lit("pipeline-"), F.lower("region_name")).alias("component"), "batch_id"
    ).agg(
        F.unix_timestamp(F.max("minute")).cast("double").alias("last_flush_time"),
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("road_key").alias("gold_records"),
    )


def component_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Component status rows, one per part and a later one for every third part."""
    key = F.col("p_partkey")
    used = (key * 1536).cast("string")
    nothing = F.lit(None).cast("string")
    metric = lambda name, value, human, unit: F.struct(
        F.lit(name).alias("name"), value.alias("value"), human.alias("human"), unit.alias("unit")
    )
    metrics = F.array(
        metric(" RAM usada", used, nothing, F.lit("bytes")),
        metric("Tamano", key.cast("string"), F.when(key % 2 == 0, F.concat(key, F.lit(" rows"))), nothing),
        metric("CPU", F.when(key % 4 != 0, F.concat(key % 100, F.lit(".25"))), nothing, F.lit("percent")),
    )
    base = src.load(spark, sf, "part").select(
        F.concat(F.lit("component-"), key).alias("component"),
        F.when(F.col("p_size") > 40, "delayed").otherwise("ok").alias("status"),
        F.when(key % 7 == 0, "storage").otherwise("pipeline").alias("category"),
        F.when(key % 5 == 0, "now").alias("human_lag"),
        (key * 37).cast("double").alias("lag_seconds"),
        F.when(key % 8 == 0, F.col("p_size") / F.lit(2.0)).alias("usage_percent"),
        metrics.alias("metrics"), key.alias("ord"), key.alias("_key"),
    )
    later = base.where(F.col("_key") % 3 == 0).withColumns({
        "status": F.lit("restarted"), "ord": F.col("ord") + F.lit(1 << 40),
    })
    return base.unionByName(later).drop("_key")
