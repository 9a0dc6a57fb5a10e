"""Traffic inputs derived from the star-schema tables: an event stream and road counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.schemas import CLASS_FIELDS, RAW_TO_CLEAN
from roadpulse.session import configure

_EPOCH_2024 = 1704067200000000  # microseconds
_TIME_COMPRESSION = 60  # 30 days of events become 12 hours, so minutes hold several events


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def traffic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed traffic events, one per row of ``events``."""
    e = load(spark, sf_dir, "events")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = e.join(c, F.col("user_id") == F.col("c_custkey")).join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    value = F.floor("value").cast("bigint")
    ts = F.expr(
        f"timestamp_micros((unix_micros(cast(ts as timestamp)) - {_EPOCH_2024}) "
        f"div {_TIME_COMPRESSION} + {_EPOCH_2024})"
    )
    direction = (
        F.when(F.col("event_type") == "click", "N").when(F.col("event_type") == "view", "S")
        .when(F.col("event_type") == "purchase", "E").when(F.col("event_type") == "signup", "W")
    )
    road = uid % 40
    return joined.select(
        F.lit("traffic.raw").alias("topic"),
        F.lit(0).alias("partition"),
        eid.alias("offset"),
        (eid.cast("double") / 500).cast("bigint").alias("batch_id"),
        eid.cast("string").alias("event_id"),
        ts.alias("event_timestamp"),
        F.col("r_name").alias("region_name"),
        F.col("n_name").alias("local_authority_name"),
        F.when(eid % 37 != 0, F.concat(F.lit("road:"), road)).alias("road_id"),
        F.when(eid % 23 != 0, F.concat(F.lit("Road "), road)).alias("road_name"),
        F.when(uid % 3 == 0, "Minor").otherwise("Major").alias("road_type"),
        F.when(uid % 10 == 3, "Unknown start")
        .when(uid % 9 != 0, F.concat(F.lit("J"), uid % 12)).alias("start_junction_road_name"),
        F.when(uid % 9 == 1, "").otherwise(F.concat(F.lit("J"), uid % 7)).alias("end_junction_road_name"),
        direction.alias("travel_direction"),
        value.alias("all_motor_vehicle_count"),
        *[
            F.when(eid % len(CLASS_FIELDS) == i, value + 1).otherwise(F.lit(0)).cast("bigint").alias(name)
            for i, name in enumerate(CLASS_FIELDS)
        ],
        (k / F.lit(10.0)).alias("link_length_kilometers"),
        F.when(eid % 5 != 0, k / F.lit(16.0)).alias("link_length_miles"),
        F.when(eid % 4 != 0, eid % 3).alias("all_heavy_goods_vehicle_count"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON text with the faults a live stream has.

    Some payloads are cut off or are arrays; some counts are text, fractions or words;
    times use other fields, offsets, the compact form or cannot be read.
    """
    t = traffic_events(spark, sf_dir)
    eid = F.col("offset")
    iso = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss")
    ahead = F.date_format(F.col("event_timestamp") + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss")
    stamp = (
        F.when(eid % 17 == 0, "")
        .when(eid % 17 == 1, "not a time")
        .when(eid % 17 == 2, F.concat(ahead, F.lit("+01:00")))
        .when(eid % 17 == 3, F.date_format("event_timestamp", "yyyyMMdd'T'HHmmss"))
        .when(eid % 17 == 4, F.date_format("event_timestamp", "yyyy-MM-dd"))
        .otherwise(F.concat(iso, F.lit("Z")))
    )
    total = F.col("all_motor_vehicle_count").cast("string")
    # Quoted or bare, as the producer wrote it.
    count_json = (
        F.when(eid % 13 == 0, F.concat(F.lit('" '), total, F.lit(' "')))
        .when(eid % 13 == 1, F.concat(F.lit('"'), total, F.lit('.5"')))
        .when(eid % 13 == 2, F.concat(total, F.lit(".75")))
        .when(eid % 13 == 3, F.lit('"many"'))
        .otherwise(total)
    )
    plain = [
        "event_id", "region_name", "local_authority_name", "road_id", "road_name", "road_type",
        "start_junction_road_name", "end_junction_road_name", "travel_direction",
        "link_length_kilometers", "link_length_miles", "all_heavy_goods_vehicle_count", *CLASS_FIELDS,
    ]
    rest = F.to_json(F.struct(
        *[F.col(n) for n in plain],
        stamp.alias("event_timestamp"),
        F.when(eid % 17 == 0, F.concat(iso, F.lit("Z"))).alias("timestamp"),
    ))
    body = F.concat(F.lit('{"all_motor_vehicle_count":'), count_json, F.lit(","), F.substr(rest, F.lit(2)))
    # Every 53rd payload is cut off, every 59th is an array.
    array = eid % 59 == 0
    wrapped = F.concat(F.when(array, "[").otherwise(""), body, F.when(array, "]").otherwise(""))
    value = F.when(eid % 53 == 0, F.substring(wrapped, 1, 40)).otherwise(wrapped)
    return t.select(
        "topic", "partition", "offset",
        F.date_trunc("hour", "event_timestamp").alias("ingest_ts"), value.alias("value"),
    )


def traffic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly road counts, one per row of ``lineitem``; directions are raw codes."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    joined = (
        li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(_places(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    supp, part = F.col("l_suppkey"), F.col("l_partkey")
    klass = F.col("l_linenumber") + part % 5 - 1
    return joined.select(
        supp.cast("string").alias("count_point_identifier"),
        F.col("l_shipdate").cast("date").alias("observation_date"),
        (7 + F.col("l_orderkey") % 12).cast("int").alias("hour_of_day"),
        F.when(part % 29 != 0, (1 + F.col("l_linenumber") % 8).cast("string")).alias("travel_direction"),
        F.col("r_name").alias("region_name"),
        F.col("n_name").alias("local_authority_name"),
        # Two names of one slug among them.
        F.when((part % 50 == 7) & (F.col("l_linenumber") % 2 == 0), "A 7").when(part % 50 == 7, "A-7")
        .otherwise(F.concat(F.lit("A"), part % 50)).alias("road_name"),
        F.when(F.col("p_size") > 25, "Major").otherwise("Minor").alias("road_type"),
        F.col("p_brand").alias("start_junction_road_name"),
        F.col("p_type").alias("end_junction_road_name"),
        (50 + supp / F.lit(20.0)).alias("latitude"),
        (-(supp / F.lit(50.0))).alias("longitude"),
        (400000 + supp * 100).cast("double").alias("british_national_grid_easting"),
        (200000 + supp * 50).cast("double").alias("british_national_grid_northing"),
        (F.col("l_extendedprice") / F.lit(10000.0)).alias("link_length_kilometers"),
        (F.col("l_extendedprice") / F.lit(10000.0) / F.lit(1.60934)).alias("link_length_miles"),
        *[
            F.when(klass == i, F.col("l_quantity")).otherwise(F.lit(0.0)).alias(name)
            for i, name in enumerate(CLASS_FIELDS)
        ],
        F.col("l_quantity").alias("all_motor_vehicle_count"),
        # A BIGINT order fits the fixed-width buffers of a hash aggregate; a struct does not.
        # It can repeat; "first" then goes by the text.
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("record_ord"),
    )


def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts under their source names, all text, with faulty values injected."""
    c = traffic_counts(spark, sf_dir)
    clean_to_raw = {v: k for k, v in RAW_TO_CLEAN.items()}
    o = F.col("record_ord") % 97
    faults = {
        "all_motor_vehicle_count": F.when(o == 1, "x"),
        "link_length_kilometers": F.when(o == 2, ""),
        "latitude": F.when(o == 3, "north"),
        "road_name": F.when(o == 4, "   ").when(o == 5, "nan").when(o == 6, F.concat(F.lit("  "), F.col("road_name"), F.lit(" "))),
        "hour_of_day": F.when(o == 7, "late"),
        "observation_date": F.when(o == 8, "31/31/2001"),
        "local_authority_name": F.when(o == 9, "None"),
        "travel_direction": F.when(o == 10, " 3 ").when(o == 11, "C"),
    }
    out = []
    for name in c.columns:
        if name == "record_ord":
            continue
        text = F.col(name).cast("string")
        text = F.coalesce(faults[name], text) if name in faults else text
        raw = clean_to_raw[name]
        out.append(text.alias({"count_date": " Count_Date ", "hour": "HOUR"}.get(raw, raw)))
    return c.select("record_ord", F.lit("9").alias("region_id"), F.lit("99").alias("local_authority_id"), *out)
