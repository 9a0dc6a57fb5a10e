"""Fixed column lists, names and schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Vehicle classes as (event field, gold column, profile key).
VEHICLE_CLASSES = (
    ("pedal_cycle_count", "pedal_cycles", "pedal_cycle"),
    ("two_wheeled_motor_vehicle_count", "two_wheeled_motor_vehicles", "two_wheeled_motor_vehicle"),
    ("car_and_taxi_count", "cars_and_taxis", "car_and_taxi"),
    ("bus_and_coach_count", "buses_and_coaches", "bus_and_coach"),
    ("light_goods_vehicle_count", "light_goods_vehicles", "light_goods_vehicle"),
    ("heavy_goods_vehicle_2_rigid_axles_count", "hgv_2_rigid_axles", "heavy_goods_vehicle_2_rigid_axles"),
    ("heavy_goods_vehicle_3_rigid_axles_count", "hgv_3_rigid_axles", "heavy_goods_vehicle_3_rigid_axles"),
    ("heavy_goods_vehicle_4_plus_rigid_axles_count", "hgv_4_plus_rigid_axles", "heavy_goods_vehicle_4_plus_rigid_axles"),
    ("heavy_goods_vehicle_3_or_4_articulated_axles_count", "hgv_3_or_4_articulated_axles", "heavy_goods_vehicle_3_or_4_articulated_axles"),
    ("heavy_goods_vehicle_5_articulated_axles_count", "hgv_5_articulated_axles", "heavy_goods_vehicle_5_articulated_axles"),
    ("heavy_goods_vehicle_6_articulated_axles_count", "hgv_6_articulated_axles", "heavy_goods_vehicle_6_articulated_axles"),
)
CLASS_FIELDS = tuple(c[0] for c in VEHICLE_CLASSES)
CLASS_GOLD = tuple(c[1] for c in VEHICLE_CLASSES)
HEAVY_FIELDS = tuple(f for f in CLASS_FIELDS if f.startswith("heavy_goods_vehicle_"))

# Raw count columns and the names they get.
RAW_TO_CLEAN = {
    "count_point_id": "count_point_identifier",
    "count_date": "observation_date",
    "hour": "hour_of_day",
    "direction_of_travel": "travel_direction",
    "region_name": "region_name",
    "local_authority_name": "local_authority_name",
    "road_name": "road_name",
    "road_type": "road_type",
    "start_junction_road_name": "start_junction_road_name",
    "end_junction_road_name": "end_junction_road_name",
    "easting": "british_national_grid_easting",
    "northing": "british_national_grid_northing",
    "latitude": "latitude",
    "longitude": "longitude",
    "link_length_km": "link_length_kilometers",
    "link_length_miles": "link_length_miles",
    "pedal_cycles": "pedal_cycle_count",
    "two_wheeled_motor_vehicles": "two_wheeled_motor_vehicle_count",
    "cars_and_taxis": "car_and_taxi_count",
    "buses_and_coaches": "bus_and_coach_count",
    "lgvs": "light_goods_vehicle_count",
    "hgvs_2_rigid_axle": "heavy_goods_vehicle_2_rigid_axles_count",
    "hgvs_3_rigid_axle": "heavy_goods_vehicle_3_rigid_axles_count",
    "hgvs_4_or_more_rigid_axle": "heavy_goods_vehicle_4_plus_rigid_axles_count",
    "hgvs_3_or_4_articulated_axle": "heavy_goods_vehicle_3_or_4_articulated_axles_count",
    "hgvs_5_articulated_axle": "heavy_goods_vehicle_5_articulated_axles_count",
    "hgvs_6_articulated_axle": "heavy_goods_vehicle_6_articulated_axles_count",
    "all_hgvs": "all_heavy_goods_vehicle_count",
    "all_motor_vehicles": "all_motor_vehicle_count",
}
RAW_DROPPED = ("region_id", "local_authority_id")

# Travel direction codes.
DIRECTION_CODES = {
    "1": "Northbound",
    "2": "Southbound",
    "3": "Eastbound",
    "4": "Westbound",
    "5": "Inner",
    "6": "Outer",
    "7": "Clockwise",
    "8": "Anticlockwise",
}

# Columns of the clean counts.
CLEAN_TEXT = (
    "count_point_identifier", "travel_direction", "region_name", "local_authority_name",
    "road_name", "road_type", "start_junction_road_name", "end_junction_road_name",
)
LOCATION_FIELDS = (
    "latitude", "longitude", "british_national_grid_easting", "british_national_grid_northing",
)
LENGTH_FIELDS = ("link_length_kilometers", "link_length_miles")
CLEAN_NUMERIC = (
    LENGTH_FIELDS + CLASS_FIELDS
    + ("all_heavy_goods_vehicle_count", "all_motor_vehicle_count") + LOCATION_FIELDS
)
CLEAN_ESSENTIAL = (
    "count_point_identifier", "observation_date", "hour_of_day", "region_name",
    "local_authority_name", "road_name", "road_type", "link_length_kilometers",
    "all_motor_vehicle_count",
)
PROFILE_REQUIRED = ("road_name", "all_motor_vehicle_count", "hour_of_day", "observation_date")

# Texts that stand for a missing value when clean counts come as CSV.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

CLEAN_COUNTS = T.StructType(
    [T.StructField(n, T.StringType()) for n in CLEAN_TEXT]
    + [T.StructField("observation_date", T.DateType()), T.StructField("hour_of_day", T.IntegerType())]
    + [T.StructField(n, T.DoubleType()) for n in CLEAN_NUMERIC]
)

# Transport columns that travel with every event payload.
RAW_EVENT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ingest_ts", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

GOLD_ADDITIVE = ("total_vehicles", "event_count", "heavy_vehicles") + CLASS_GOLD
GOLD = T.StructType(
    [T.StructField("role", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in (
        "region_name", "local_authority_name", "road_id", "road_name", "road_type",
        "start_junction_name", "end_junction_name")]
    + [T.StructField("link_length_kilometers", T.DoubleType())]
    + [T.StructField(n, T.LongType()) for n in GOLD_ADDITIVE]
    + [T.StructField(n, T.DoubleType()) for n in (
        "avg_vehicles", "total_link_length_km", "vehicles_per_km")]
    + [T.StructField("batch_id", T.LongType()), T.StructField("batch_timestamp", T.LongType()),
       T.StructField("event_timestamp", T.TimestampType()),
       T.StructField("writer_failover_active", T.BooleanType())]
)

# As stored: the batch is a partition folder below day and hour.
STORED_GOLD = T.StructType(
    [f for f in GOLD.fields if f.name != "batch_id"]
    + [T.StructField("dt", T.StringType()), T.StructField("hour", T.StringType()), T.StructField("batch_id", T.LongType())]
)

# Hours folded by the maintenance job: all batches up to ``upto`` in one row per key and minute.
FOLDED_GOLD = T.StructType([f for f in STORED_GOLD.fields if f.name != "batch_id"] + [T.StructField("upto", T.LongType())])

STATE_STAT = T.StructType([
    T.StructField("road_id", T.StringType()),
    T.StructField("hour", T.IntegerType()),  # null: the road's overall statistic
    T.StructField("count", T.LongType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("m2", T.DoubleType()),
])
STATE_DIRECTION = T.StructType([
    T.StructField("road_id", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("count", T.LongType()),
])
META_FIELDS = ("road_name", "region_name", "region_id", "local_authority_name", "road_type")
STATE_META = T.StructType(
    [T.StructField("road_id", T.StringType())]
    + [T.StructField(n, T.StringType()) for n in META_FIELDS]
)

RUN_LOG = T.StructType([
    T.StructField("component", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("last_flush_time", T.DoubleType()),
    T.StructField("total_events", T.LongType()),
    T.StructField("gold_records", T.LongType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("writer_failover_active", T.BooleanType()),
])

# A metric value is any JSON scalar, kept as text.
METRIC = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("human", T.StringType()),
    T.StructField("unit", T.StringType()),
])
