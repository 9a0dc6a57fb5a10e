"""Raw road counts to the clean, typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions.text import known_text, strip
from roadpulse.schemas import (
    CLEAN_COUNTS, CLEAN_ESSENTIAL, CLEAN_TEXT, DIRECTION_CODES, PROFILE_REQUIRED,
    RAW_DROPPED, RAW_TO_CLEAN,
)


class MissingColumns(ValueError):
    """The counts lack columns that the profiles need."""


def rename_columns(df: DataFrame) -> DataFrame:
    """Source names, stripped and in any case, to clean names; others stay."""
    names = {**RAW_TO_CLEAN, "date": "observation_date", "count_point_identifier": "count_point_identifier"}
    new = {}
    for column in df.columns:
        key = column.strip()
        target = names.get(key, names.get(key.lower()))
        if target:
            new[column] = target
    return df.withColumnsRenamed(new)


def clean_counts(raw: DataFrame) -> DataFrame:
    """One projection over the raw text columns; unreadable values become null."""
    df = rename_columns(raw).drop(*RAW_DROPPED)
    types = {f.name: f.dataType for f in CLEAN_COUNTS.fields}
    missing = {n: F.lit(None).cast(types[n]) for n in CLEAN_ESSENTIAL if n not in df.columns}
    if "all_motor_vehicle_count" in missing and "all_motor_vehicles" in df.columns:
        missing["all_motor_vehicle_count"] = F.col("all_motor_vehicles")
    df = df.withColumns(missing) if missing else df

    def typed(name: str, dtype: T.DataType) -> bool:
        return df.schema[name].dataType == dtype

    codes = F.create_map(*[F.lit(x) for pair in DIRECTION_CODES.items() for x in pair])
    cleaned = {}
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in types and name not in CLEAN_TEXT:
            # Columns that come typed need no reading; a cast skips the blanks around a number.
            if name == "hour_of_day" and not typed(name, types[name]):
                # Whole hours may come with a decimal point.
                cleaned[name] = F.coalesce(c.try_cast("int"), c.try_cast("double").try_cast("int"))
            elif not typed(name, types[name]):
                cleaned[name] = c.try_cast(types[name])
        elif name == "travel_direction":
            text = known_text(c)
            cleaned[name] = F.coalesce(F.try_element_at(codes, text), text)
        elif name in CLEAN_TEXT:
            cleaned[name] = known_text(c.cast("string"))
    return df.withColumns(cleaned)


def prepare_counts(clean: DataFrame) -> DataFrame:
    """Rows fit for profiles, with ``hour`` and defaulted region, authority and direction.

    The null check on the total comes before its conversion: text totals count as 0.
    ``*_filled`` columns carry the defaults; the plain ones keep their nulls, which the
    road profiles skip.
    """
    absent = sorted(set(PROFILE_REQUIRED) - set(clean.columns))
    if absent:
        raise MissingColumns(", ".join(absent))
    optional = [n for n in CLEAN_TEXT if n not in clean.columns]
    df = clean.withColumns({n: F.lit(None).cast("string") for n in optional}) if optional else clean
    rows = df.dropna(subset=["road_name", "all_motor_vehicle_count", "hour_of_day"])
    return (
        rows.withColumns({
            "road_name": strip(F.col("road_name")),
            "all_motor_vehicle_count": F.coalesce(
                F.col("all_motor_vehicle_count").try_cast("double"), F.lit(0.0)
            ),
            "hour": F.col("hour_of_day").try_cast("int"),
            "observation_date": F.col("observation_date").try_cast("date"),
        })
        .where((F.col("road_name") != "") & F.col("hour").isNotNull() & F.col("observation_date").isNotNull())
        .transform(fill_dimensions)
    )


def fill_dimensions(df: DataFrame) -> DataFrame:
    named = lambda c, default: F.coalesce(F.nullif(strip(F.col(c)), F.lit("")), F.lit(default))
    return df.withColumns({
        "region_filled": named("region_name", "Unknown Region"),
        "authority_filled": named("local_authority_name", "Unknown Authority"),
        "direction_filled": strip(F.coalesce("travel_direction", F.lit("Unknown"))),
    })
