"""Oracle SQL: cleaning and profiles of the road counts."""

from __future__ import annotations

from oracle.parts import (
    COUNTS, COUNTS_RAW, FIELDS, KEYS, REGION_CTES, ROAD_CTES, classes, cols, direction_name, query,
    region_shares,
)

_R6 = "round({0}, 6) AS {0}"

# What is left of the injected faults after cleaning, by the fault number.
_CLEANED = f"""cleaned AS (
  SELECT ord, CAST(ord % 97 AS INTEGER) AS o, point AS count_point_identifier, code,
    CASE WHEN ord % 97 <> 8 THEN day END AS day,
    CASE WHEN ord % 97 <> 7 THEN hour END AS hour_of_day,
    CASE WHEN ord % 97 = 10 THEN 'Eastbound' WHEN ord % 97 = 11 THEN 'C' ELSE {direction_name("code")} END AS travel_direction,
    region_name, CASE WHEN ord % 97 <> 9 THEN local_authority_name END AS local_authority_name,
    CASE WHEN ord % 97 NOT IN (4, 5) THEN road_name END AS road_name, road_type,
    sj AS start_junction_road_name, ej AS end_junction_road_name,
    easting AS british_national_grid_easting, northing AS british_national_grid_northing,
    CASE WHEN ord % 97 <> 3 THEN latitude END AS latitude, longitude,
    CASE WHEN ord % 97 <> 2 THEN km END AS link_length_kilometers, miles AS link_length_miles, {cols(FIELDS)},
    CASE WHEN ord % 97 <> 1 THEN total END AS all_motor_vehicle_count
  FROM counts)"""

_PREPARED = """prepared AS (
  SELECT ord, road_name, all_motor_vehicle_count, hour_of_day AS hour, day, region_name AS region_filled,
    coalesce(local_authority_name, 'Unknown Authority') AS authority_filled,
    coalesce(travel_direction, 'Unknown') AS direction_filled
  FROM cleaned WHERE road_name IS NOT NULL AND all_motor_vehicle_count IS NOT NULL
    AND hour_of_day IS NOT NULL AND day IS NOT NULL)"""

_SEGMENTS = """SELECT 'segment:' || point AS segment_id, point AS count_point_identifier,
  arg_min(region_name, row(ord, region_name)) AS region_name, arg_min(local_authority_name, row(ord, local_authority_name)) AS local_authority_name,
  arg_min(road_name, row(ord, road_name)) AS road_name, arg_min(road_type, row(ord, road_type)) AS road_type,
  arg_min(sj, row(ord, sj)) AS start_junction_road_name, arg_min(ej, row(ord, ej)) AS end_junction_road_name,
  round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
  round(avg(easting), 6) AS british_national_grid_easting, round(avg(northing), 6) AS british_national_grid_northing,
  round(avg(km), 6) AS link_length_kilometers, round(avg(miles), 6) AS link_length_miles,
  string_agg(DISTINCT CASE WHEN code IS NOT NULL THEN direction END, ';'
    ORDER BY CASE WHEN code IS NOT NULL THEN direction END) AS available_directions,
  strftime(min(day), '%Y-%m-%d') AS observation_start_date, strftime(max(day), '%Y-%m-%d') AS observation_end_date,
  count(*) AS total_observations, round(sum(total), 6) AS all_motor_vehicle_total
FROM cnt GROUP BY point"""

_STAT_NAMES = ("latitude", "longitude", "easting", "northing", "kilometers", "miles")
_LEAST = {"latitude": "0.001e0", "longitude": "0.001e0", "easting": "1.0e0", "northing": "1.0e0",
          "kilometers": "0.001e0", "miles": "0.001e0"}
_ROAD_TEXT = "region_name, local_authority_name, road_type, start_junction, end_junction"
_ROAD_STATS = ", ".join(f"round({n}_mean, 6) AS {n}_mean, round({n}_std, 6) AS {n}_std" for n in _STAT_NAMES)


def _std(n: str) -> str:
    return f"CASE WHEN {n}_std = 0 THEN {_LEAST[n]} ELSE {n}_std END"


_PROFILE_STATS = ", ".join(f"round({n}_mean, 6) AS {n}_mean, round({_std(n)}, 6) AS {n}_std" for n in _STAT_NAMES)
# Lower limits of a profile that is read back.
_FLOORS = {"latitude": (None, 0.0005), "longitude": (None, 0.0005), "easting": (None, 1.0), "northing": (None, 1.0),
           "kilometers": (0.05, 0.01), "miles": (0.03, 0.01)}
_VALID_STATS = ", ".join(
    f"round({f'greatest({n}_mean, {lo}e0)' if lo else f'{n}_mean'}, 6) AS {n}_mean, "
    f"round(greatest({_std(n)}, {least}e0), 6) AS {n}_std"
    for n, (lo, least) in _FLOORS.items()
)
_ROAD_NUMBERS = "round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute, observation_count, days_observed"


def _class_shares(by: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {by}, '{k}' AS key, sum({f}) AS v FROM cnt GROUP BY {by}" for f, k in zip(FIELDS, KEYS)
    )
    return f"SELECT {by}, key, round(v / t, 6) AS weight FROM (SELECT *, sum(v) OVER (PARTITION BY {by}) AS t FROM ({rows})) WHERE v > 0"


_PROFILED = "region_name IN (SELECT region_name FROM road)"
_ROAD_SHARE = f"""SELECT r.region_name, r.road_id, s.weight FROM road r
  JOIN ({region_shares("road_name")}) s ON r.region_name = s.region_name AND r.road_name = s.key"""

COUNT_QUERIES = {
    "clean_counts": query(COUNTS_RAW, _CLEANED, select=f"""SELECT ord AS record_ord, count_point_identifier,
      strftime(day, '%Y-%m-%d') AS observation_date, hour_of_day, travel_direction, region_name, local_authority_name,
      road_name, road_type, start_junction_road_name, end_junction_road_name, {cols(
        ["british_national_grid_easting", "british_national_grid_northing", "latitude", "longitude",
         "link_length_kilometers", "link_length_miles", *FIELDS, "all_motor_vehicle_count"], _R6)} FROM cleaned"""),
    "prepare_counts": query(COUNTS_RAW, _CLEANED, _PREPARED, select="""SELECT ord AS record_ord, road_name,
      all_motor_vehicle_count, hour, strftime(day, '%Y-%m-%d') AS observation_date, region_filled, authority_filled,
      direction_filled FROM prepared"""),
    "segment_catalogue": query(*COUNTS, select=_SEGMENTS),
    "road_base_stats": query(*ROAD_CTES, select=f"""SELECT road_name, observation_count, days_observed, {_ROAD_TEXT},
      {_ROAD_STATS} FROM road_base"""),
    "road_direction_mix": query(*COUNTS, select="""SELECT road_name, direction AS key,
      round(t / sum(t) OVER (PARTITION BY road_name), 6) AS weight
      FROM (SELECT road_name, direction, sum(total) AS t FROM cnt GROUP BY road_name, direction)"""),
    "road_hour_profile": query(*ROAD_CTES, select="""SELECT road_name, hour, round(mean_per_minute, 6) AS mean_per_minute,
      round(std_per_minute, 6) AS std_per_minute, observations FROM road_hour"""),
    "road_vehicle_mix": query(*COUNTS, select=_class_shares("road_name")),
    "road_baseline": query(*ROAD_CTES, select="""SELECT road_name, round(avg(mean_per_minute), 6) AS baseline_rate_per_minute
      FROM road_hour GROUP BY road_name"""),
    "road_profile": query(*ROAD_CTES, select=f"""SELECT road_id, road_name, {_ROAD_TEXT}, {_PROFILE_STATS}, {_ROAD_NUMBERS} FROM road"""),
    "validated_profile": query(*ROAD_CTES, select=f"""SELECT road_id, road_name, {_ROAD_TEXT}, {_VALID_STATS}, {_ROAD_NUMBERS} FROM road"""),
    "region_hour_profile": query(*REGION_CTES, select="""SELECT region_name, hour, round(mean_per_minute, 6) AS mean_per_minute,
      round(std_per_minute, 6) AS std_per_minute, observations FROM region_hour"""),
    "region_vehicle_mix": query(*REGION_CTES, select=f"SELECT * FROM ({_class_shares('region_name')}) WHERE {_PROFILED}"),
    "region_direction_mix": query(*REGION_CTES, select=f"SELECT region_name, key, round(weight, 6) AS weight FROM ({region_shares('direction')}) WHERE {_PROFILED}"),
    "region_authority_mix": query(*REGION_CTES, select=f"SELECT region_name, key, round(weight, 6) AS weight FROM ({region_shares('local_authority_name')}) WHERE {_PROFILED}"),
    "region_road_share": query(*REGION_CTES, select=f"SELECT region_name, road_id, round(weight, 6) AS weight FROM ({_ROAD_SHARE})"),
    "region_profile": query(*REGION_CTES, select="""SELECT region_id, region_name, road_count,
      round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute, observation_count, days_observed FROM region_row"""),
    "road_index": query(*ROAD_CTES, select="""SELECT road_id AS id, road_name, region_name, local_authority_name,
      round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute FROM road_named ORDER BY road_name"""),
    "region_index": query(*REGION_CTES, select="""SELECT region_id AS id, region_name, road_count,
      round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute FROM region_row ORDER BY region_name"""),
    "profile_meta": query(*REGION_CTES, select="""SELECT 'spark' AS source, CAST(50 AS INTEGER) AS min_observations,
      (SELECT count(*) FROM road) AS road_count, (SELECT count(*) FROM region_row) AS region_count,
      (SELECT count(DISTINCT point) FROM cnt) AS segment_count"""),
    "region_slices": query(*REGION_CTES, select="""SELECT lower(replace(region_name, ' ', '-')) AS region_slug, region_id, region_name,
      r.road_count AS slice_road_count, road_id, road_name, local_authority_name,
      round(road.baseline_rate_per_minute, 6) AS baseline_rate_per_minute, road.observation_count
      FROM region_row r JOIN road USING (region_name)"""),
    "list_regions_clean": query(*REGION_CTES, select="""SELECT region_id, region_name,
      CASE WHEN length(region_name) IN (4, 7) THEN 0.0e0 ELSE round(baseline_rate_per_minute, 6) END AS baseline_rate,
      CASE WHEN length(region_name) = 6 THEN 0 ELSE road_count END AS road_count FROM region_row"""),
    "first_available": query(*ROAD_CTES, select="""SELECT road_id, road_name, round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute, choice
      FROM road CROSS JOIN (VALUES ('first'), ('second')) AS c(choice)"""),
}
