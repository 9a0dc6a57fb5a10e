"""Event payloads to one normalised row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions import measures as M
from roadpulse.functions.parsing import minute_bucket, parse_ts, safe_int
from roadpulse.functions.text import first_text, slugify, strip
from roadpulse.schemas import VEHICLE_CLASSES

UNKNOWN = "Unknown"
UNKNOWN_ROAD = "Unknown road"
TIME_FIELDS = ("event_timestamp", "timestamp", "observation_time")
_TRANSPORT = ("topic", "partition", "offset", "ingest_ts", "batch_id", "value")
# An arrival number keeps the partition above the offset in one BIGINT,
# so "first event" needs no struct in the aggregation buffers.
_OFFSET_BITS = 48


def _is_object(v: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def parsed_payloads(raw: DataFrame) -> DataFrame:
    """Every payload parsed once: VARIANT column ``v`` and whether it is a JSON object (``is_object``).
    Kept (persisted) by a job that needs both the objects and the dead letters."""
    return raw.withColumn("v", F.try_parse_json("value")).withColumn("is_object", _is_object("v"))


def object_payloads(raw: DataFrame) -> DataFrame:
    """Payloads that are JSON objects, parsed once into a VARIANT column ``v``.

    A plain filter on the parsed value would be pushed below the projection and parse
    every payload a second time; an explode of none or one keeps it to one.
    """
    parsed = raw.withColumn("_v", F.try_parse_json("value"))
    return parsed.select(*raw.columns, F.explode(F.when(_is_object("_v"), F.array("_v"))).alias("v"))


def dead_letters(raw: DataFrame) -> DataFrame:
    """Payloads that are no JSON object: broken text, arrays, bare values."""
    return raw.withColumn("_v", F.try_parse_json("value")).where(~_is_object("_v")).drop("_v")


class VariantFields:
    """Fields of a VARIANT column. Each field that is asked for is looked up in the object once, in
    a projection of its own (``extracted``); every type it is wanted in is cast from there."""

    def __init__(self, v: str = "v"):
        self.v, self.names = v, {}

    def __call__(self, name: str, dtype: str) -> Column:
        self.names[name] = f"_field_{name}"
        return F.try_variant_get(F.col(self.names[name]), "$", dtype)

    def extracted(self, events: DataFrame, kept: list[str]) -> DataFrame:
        return events.select(*kept, *[
            F.try_variant_get(F.col(self.v), f"$.{name}", "variant").alias(column) for name, column in self.names.items()])


def variant_fields(v: str = "v") -> VariantFields:
    return VariantFields(v)


def column_fields(df: DataFrame) -> M.Field:
    """Reads typed columns; columns the frame lacks are null."""

    def field(name: str, dtype: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(dtype)
        return F.col(name) if df.schema[name].dataType.simpleString() == dtype else F.col(name).try_cast(dtype)

    return field


def _event_time(df: DataFrame, field: M.Field) -> Column:
    """First non-empty time field; unreadable times take the ingest time, never the wall clock."""
    typed = [n for n in TIME_FIELDS if n in df.columns and isinstance(df.schema[n].dataType, T.TimestampType)]
    if typed:
        ts = F.coalesce(*[F.col(n) for n in typed])
    else:
        ts = parse_ts(first_text(*[field(n, "string") for n in TIME_FIELDS]))
    return F.coalesce(ts, F.col("ingest_ts")) if "ingest_ts" in df.columns else ts


def normalise_events(
    events: DataFrame, *, field: M.Field | None = None, heavy_fallback: str = "zero"
) -> DataFrame:
    """One wide typed row per event. Pure projection: no shuffle, no Python.

    ``events`` holds typed columns, or a VARIANT column when ``field`` is given.
    """
    field = field or column_fields(events)
    text = lambda name: field(name, "string")

    road_name = strip(F.coalesce(first_text(text("road_name")), F.lit(UNKNOWN_ROAD)))
    kept = [c for c in _TRANSPORT if c in events.columns]
    columns = [
        *kept,
        text("event_id").alias("event_id"),
        F.coalesce(first_text(text("region_name")), F.lit(UNKNOWN)).alias("region_name"),
        F.coalesce(first_text(text("local_authority_name")), F.lit(UNKNOWN)).alias("local_authority_name"),
        F.coalesce(strip(text("road_id")), F.lit("")).alias("road_id"),
        road_name.alias("road_name"),
        strip(F.coalesce(first_text(text("road_type")), F.lit(UNKNOWN))).alias("road_type"),
        _stripped_first(text, "start").alias("_start"),
        _stripped_first(text, "end").alias("_end"),
        _event_time(events, field).alias("event_ts"),
        M.link_length_km(
            field("link_length_kilometers", "double"), field("link_length_miles", "double")
        ).alias("link_length_km"),
        safe_int(field("all_motor_vehicle_count", "bigint")).alias("total_vehicles"),
        M.heavy_count(field, heavy_fallback).alias("heavy_vehicles"),
        *[safe_int(field(src, "bigint")).alias(dst) for src, dst, _ in VEHICLE_CLASSES],
        M.vehicle_count(field).alias("vehicle_count"),
        M.direction_of(field).alias("direction"),
        # Descriptors as the running profiles keep them: trimmed, other defaults.
        _meta(text, "road_name", strip(text("road_id"))).alias("meta_road_name"),
        _meta(text, "region_name", F.lit(UNKNOWN)).alias("meta_region_name"),
        _meta(text, "region_id").alias("meta_region_id"),
        _meta(text, "local_authority_name", F.lit(UNKNOWN)).alias("meta_local_authority_name"),
        _meta(text, "road_type").alias("meta_road_type"),
    ]
    base = (field.extracted(events, kept) if isinstance(field, VariantFields) else events).select(*columns)
    start = F.coalesce("_start", F.concat("road_name", F.lit(" (inicio)")))
    end = F.coalesce("_end", F.concat("road_name", F.lit(" (fin)")))
    key = F.concat("road_name", F.lit(":"), "start_junction", F.lit("->"), "end_junction")
    return (
        base.withColumn("start_junction", start)
        .withColumn(
            "end_junction",
            F.when(F.col("start_junction") == end, F.concat(end, F.lit(" (fin)"))).otherwise(end),
        )
        .withColumns({
            "road_key": F.coalesce(F.nullif("road_id", F.lit("")), key),
            "minute": minute_bucket(F.col("event_ts")),
            "arrival": _arrival(kept),
        })
        .drop("_start", "_end")
    )


def _stripped_first(text, side: str) -> Column:
    """First non-empty of the three junction fields, trimmed; blank is null."""
    names = [f"{side}_junction_road_name", f"{side}_junction_name", f"{side}_junction"]
    return first_text(strip(first_text(*[text(n) for n in names])))


def _meta(text, name: str, default: Column | None = None) -> Column:
    return F.coalesce(first_text(strip(text(name))), F.lit("") if default is None else default, F.lit(""))


def _arrival(kept: list[str]) -> Column:
    if "offset" not in kept:
        return F.lit(None).cast("bigint")
    partition = (F.col("partition") if "partition" in kept else F.lit(0)).cast("bigint")
    fits = partition.between(0, (1 << 63 - _OFFSET_BITS) - 1) & F.col("offset").between(0, (1 << _OFFSET_BITS) - 1)
    number = F.shiftleft(partition, _OFFSET_BITS) + F.col("offset")
    wrong = F.raise_error(F.concat(F.lit("no arrival number for partition "), partition, F.lit(", offset "), F.col("offset")))
    return F.when(fits | F.col("offset").isNull() | partition.isNull(), number).otherwise(wrong.cast("bigint"))


def parse_events(raw: DataFrame, *, heavy_fallback: str = "zero") -> DataFrame:
    """JSON text to normalised events; payloads that are not JSON objects are left out."""
    return normalise_events(object_payloads(raw).drop("value"), field=variant_fields(), heavy_fallback=heavy_fallback)


def silver_keys(events: DataFrame) -> DataFrame:
    """Partition columns of the silver table for normalised events."""
    return events.withColumns({
        "region_slug": slugify(F.col("region_name")),
        "dt": F.date_format("event_ts", "yyyyMMdd"),
        "hour": F.date_format("event_ts", "HH"),
    })
