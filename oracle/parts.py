"""CTEs shared by the oracle queries."""

from __future__ import annotations

# The eleven vehicle classes as (event field, gold column, profile key).
CLASSES = (
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
FIELDS = [c[0] for c in CLASSES]
GOLD = [c[1] for c in CLASSES]
KEYS = [c[2] for c in CLASSES]


def cols(names, fmt="{}", sep=", "):
    return sep.join(fmt.format(n) for n in names)


def classes(names, expr, sep=",\n  "):
    """``expr`` with {i} and {n} for every class."""
    return sep.join(expr.format(i=i, n=n) for i, n in enumerate(names))


def query(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# --- events ---------------------------------------------------------------------------

SRC = """src AS (
  SELECT e.event_id AS eid, e.user_id AS uid, e.event_type,
    CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k,
    CAST(floor(e.value) AS BIGINT) AS v,
    make_timestamp((epoch_us(e.ts) - 1704067200000000) // 60 + 1704067200000000) AS ts,
    r_name, n_name
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_EV_BASE = f"""ev0 AS (
  SELECT eid, eid // 500 AS batch_id, ts, r_name AS region_name, n_name AS local_authority_name,
    CASE WHEN eid % 37 <> 0 THEN 'road:' || (uid % 40) ELSE '' END AS road_id,
    CASE WHEN eid % 23 <> 0 THEN 'Road ' || (uid % 40) END AS given_name,
    CASE WHEN uid % 3 = 0 THEN 'Minor' ELSE 'Major' END AS road_type,
    CASE WHEN uid % 10 = 3 THEN 'Unknown start' WHEN uid % 9 <> 0 THEN 'J' || (uid % 12) END AS s,
    CASE WHEN uid % 9 = 1 THEN NULL ELSE 'J' || (uid % 7) END AS e,
    CASE event_type WHEN 'click' THEN 'N' WHEN 'view' THEN 'S' WHEN 'purchase' THEN 'E' WHEN 'signup' THEN 'W' END AS direction,
    v AS total_vehicles,
    CASE WHEN eid % 4 <> 0 THEN eid % 3 ELSE 0 END AS heavy_vehicles,
    {classes(GOLD, "CASE WHEN eid % 11 = {i} THEN v + 1 ELSE 0 END AS {n}")},
    CAST(CASE WHEN v > 0 THEN v ELSE v + 1 END AS DOUBLE) AS vehicle_count,
    CASE WHEN k > 0 THEN k / 10.0e0
         WHEN eid % 5 <> 0 THEN k / 16.0e0 * 1.60934e0 ELSE 0.0e0 END AS link_length_km
  FROM src)"""

_EV_KEYS = """ev1 AS (
  SELECT *, coalesce(given_name, 'Unknown road') AS road_name,
    coalesce(s, coalesce(given_name, 'Unknown road') || ' (inicio)') AS start_junction,
    coalesce(e, coalesce(given_name, 'Unknown road') || ' (fin)') AS e2
  FROM ev0),
ev AS (
  SELECT * EXCLUDE (end_junction), end_junction,
    CASE WHEN road_id <> '' THEN road_id
         ELSE road_name || ':' || start_junction || '->' || end_junction END AS road_key,
    date_trunc('minute', ts) AS minute
  FROM (SELECT *, CASE WHEN start_junction = e2 THEN e2 || ' (fin)' ELSE e2 END AS end_junction FROM ev1))"""

EVENTS = [SRC, _EV_BASE, _EV_KEYS]

SUMS = ", ".join(
    ["CAST(sum(total_vehicles) AS BIGINT) AS total_vehicles", "CAST(count(*) AS BIGINT) AS event_count",
     "CAST(sum(heavy_vehicles) AS BIGINT) AS heavy_vehicles"]
    + [f"CAST(sum({n}) AS BIGINT) AS {n}" for n in GOLD]
)
MAX_LEN = "max(link_length_km) FILTER (WHERE link_length_km > 0) AS len"

FIRST_KNOWN = """
  coalesce(arg_min(road_name, eid) FILTER (WHERE road_name NOT IN ('', 'Unknown road')), arg_max(road_name, eid)) AS road_name,
  arg_min(road_type, eid) AS road_type,
  coalesce(arg_min(start_junction, eid) FILTER (WHERE start_junction NOT IN ('', 'Unknown start')), arg_max(start_junction, eid)) AS start_junction_name,
  coalesce(arg_min(end_junction, eid) FILTER (WHERE end_junction NOT IN ('', 'Unknown end')), arg_max(end_junction, eid)) AS end_junction_name"""

_RATIOS = """total_vehicles / event_count AS avg_vehicles,
  coalesce(len, 0) AS total_link_length_km,
  CASE WHEN len > 0 THEN total_vehicles / len ELSE 0 END AS vehicles_per_km"""


def gold_ctes(batch: bool = False) -> list[str]:
    """CTE ``gold``, unrounded, from CTE ``ev``."""
    b = ", batch_id" if batch else ""
    on = " AND a.batch_id = b.batch_id" if batch else ""

    def level(role, keys, nulls):
        k = ", ".join(keys)
        joined = " AND ".join(f"a.{x} = b.{x}" for x in [*keys, "minute"]) + on
        lens = (
            f"(SELECT {k}, minute{b}, sum(len) AS len FROM (SELECT {k}, road_key, minute{b}, {MAX_LEN} "
            f"FROM ev GROUP BY {k}, road_key, minute{b}) GROUP BY {k}, minute{b})"
        )
        sums = f"(SELECT {k}, minute{b}, {SUMS} FROM ev GROUP BY {k}, minute{b})"
        return (
            f"SELECT '{role}' AS role, a.region_name, {nulls}, a.minute AS event_timestamp, "
            f"{'a.batch_id, ' if batch else ''}"
            f"total_vehicles, event_count, heavy_vehicles, {cols(GOLD)}, {_RATIOS} "
            f"FROM {sums} a JOIN {lens} b ON {joined}"
        )

    no_road = (
        "CAST(NULL AS VARCHAR) AS road_id, CAST(NULL AS VARCHAR) AS road_name, CAST(NULL AS VARCHAR) AS road_type, "
        "CAST(NULL AS VARCHAR) AS start_junction_name, CAST(NULL AS VARCHAR) AS end_junction_name, "
        "CAST(NULL AS DOUBLE) AS link_length_kilometers"
    )
    road = (
        f"SELECT 'road' AS role, region_name, local_authority_name, road_key AS road_id, road_name, road_type, "
        f"start_junction_name, end_junction_name, coalesce(len, 0) AS link_length_kilometers, minute AS event_timestamp, "
        f"{'batch_id, ' if batch else ''}"
        f"total_vehicles, event_count, heavy_vehicles, {cols(GOLD)}, {_RATIOS} FROM ("
        f"SELECT region_name, local_authority_name, road_key, minute{b}, {SUMS}, {MAX_LEN}, {FIRST_KNOWN} "
        f"FROM ev GROUP BY region_name, local_authority_name, road_key, minute{b})"
    )
    return [
        "gold_primary AS (" + level("primary", ["region_name"], "CAST(NULL AS VARCHAR) AS local_authority_name, " + no_road) + ")",
        "gold_authority AS (" + level("authority", ["region_name", "local_authority_name"], "a.local_authority_name, " + no_road) + ")",
        "gold_road AS (" + road + ")",
        "gold AS (SELECT * FROM gold_primary UNION ALL BY NAME SELECT * FROM gold_authority UNION ALL BY NAME SELECT * FROM gold_road)",
    ]


GOLD_CTES = [*EVENTS, *gold_ctes()]
GOLD_OUT = (
    "role, region_name, local_authority_name, road_id, road_name, road_type, start_junction_name, end_junction_name, "
    f"round(link_length_kilometers, 6) AS link_length_kilometers, total_vehicles, event_count, heavy_vehicles, {cols(GOLD)}, "
    "round(avg_vehicles, 6) AS avg_vehicles, round(total_link_length_km, 6) AS total_link_length_km, "
    "round(vehicles_per_km, 6) AS vehicles_per_km, CAST(epoch(event_timestamp) AS BIGINT) AS batch_timestamp, event_timestamp"
)

# --- counts ---------------------------------------------------------------------------

# Travel direction codes.
DIRECTIONS = ("Northbound", "Southbound", "Eastbound", "Westbound", "Inner", "Outer", "Clockwise", "Anticlockwise")
_CASE_DIRECTION = "CASE {c} " + " ".join(f"WHEN '{i}' THEN '{d}'" for i, d in enumerate(DIRECTIONS, 1)) + " ELSE {c} END"


def direction_name(c: str) -> str:
    return _CASE_DIRECTION.format(c=c)


COUNTS_RAW = f"""counts AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS point, CAST(l_shipdate AS DATE) AS day,
    CAST(7 + l_orderkey % 12 AS INTEGER) AS hour,
    CASE WHEN l_partkey % 29 <> 0 THEN CAST(1 + l_linenumber % 8 AS VARCHAR) END AS code,
    r_name AS region_name, n_name AS local_authority_name,
    CASE WHEN l_partkey % 50 = 7 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'A 7' ELSE 'A-7' END ELSE 'A' || (l_partkey % 50) END AS road_name,
    CASE WHEN p_size > 25 THEN 'Major' ELSE 'Minor' END AS road_type, p_brand AS sj, p_type AS ej,
    50 + l_suppkey / 20.0e0 AS latitude, -(l_suppkey / 50.0e0) AS longitude,
    CAST(400000 + l_suppkey * 100 AS DOUBLE) AS easting, CAST(200000 + l_suppkey * 50 AS DOUBLE) AS northing,
    l_extendedprice / 10000.0e0 AS km, l_extendedprice / 10000.0e0 / 1.60934e0 AS miles,
    {classes(FIELDS, "CASE WHEN l_linenumber + l_partkey % 5 - 1 = {i} THEN l_quantity ELSE 0.0e0 END AS {n}")},
    l_quantity AS total,
    l_orderkey * 8 + l_linenumber AS ord
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
CNT = "cnt AS (SELECT *, coalesce(" + direction_name("code") + ", 'Unknown') AS direction FROM counts)"
COUNTS = [COUNTS_RAW, CNT]


def hour_profile(by: str) -> str:
    return (
        f"SELECT {by}, hour, avg(t) / 60 AS mean_per_minute, stddev_pop(t) / 60 AS std_per_minute, "
        f"count(t) AS observations FROM (SELECT {by}, day, hour, sum(total) AS t FROM cnt GROUP BY {by}, day, hour) "
        f"GROUP BY {by}, hour"
    )


_STATS = ("latitude", "longitude", "easting", "northing", "km", "miles")
ROAD_CTES = [
    *COUNTS,
    f"road_hour AS ({hour_profile('road_name')})",
    "road_base AS (SELECT road_name, count(*) AS observation_count, count(DISTINCT day) AS days_observed, "
    "arg_min(road_type, row(ord, road_type)) AS road_type, arg_min(region_name, row(ord, region_name)) AS region_name, "
    "arg_min(local_authority_name, row(ord, local_authority_name)) AS local_authority_name, arg_min(sj, row(ord, sj)) AS start_junction, "
    "arg_min(ej, row(ord, ej)) AS end_junction, "
    + ", ".join(
        f"avg({c}) AS {n}_mean, stddev_pop({c}) AS {n}_std"
        for c, n in zip(_STATS, ("latitude", "longitude", "easting", "northing", "kilometers", "miles"))
    )
    + " FROM cnt GROUP BY road_name)",
    "road_named AS (SELECT 'road:' || replace(lower(road_name), ' ', '-') AS road_id, b.*, h.base AS baseline_rate_per_minute "
    "FROM road_base b JOIN (SELECT road_name, avg(mean_per_minute) AS base FROM road_hour GROUP BY road_name) h "
    "USING (road_name) WHERE observation_count >= 50)",
    "road AS (SELECT * FROM road_named QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY road_name DESC) = 1)",
]
REGION_CTES = [
    *ROAD_CTES,
    f"region_hour AS ({hour_profile('region_name')})",
    "region_of AS (SELECT region_name, count(*) AS road_count, sum(baseline_rate_per_minute) AS road_base, "
    "sum(observation_count) AS observation_count FROM road GROUP BY region_name)",
    "region_row AS (SELECT 'region:' || lower(replace(region_name, ' ', '-')) AS region_id, region_name, road_count, "
    "base AS baseline_rate_per_minute, CAST(observation_count AS BIGINT) AS observation_count, days_observed FROM region_of "
    "JOIN (SELECT region_name, avg(mean_per_minute) AS base FROM region_hour GROUP BY region_name) USING (region_name) "
    "JOIN (SELECT region_name, count(DISTINCT day) AS days_observed FROM cnt GROUP BY region_name) USING (region_name))",
]


def region_shares(dim: str) -> str:
    return (
        f"SELECT region_name, {dim} AS key, t / sum(t) OVER (PARTITION BY region_name) AS weight FROM "
        f"(SELECT region_name, {dim}, sum(total) AS t FROM cnt GROUP BY region_name, {dim}) WHERE t > 0"
    )


# --- running profiles -----------------------------------------------------------------

RUN_CTES = [
    *EVENTS,
    "mt AS (SELECT road_id, minute, sum(vehicle_count) AS total FROM ev WHERE road_id <> '' GROUP BY road_id, minute)",
    "stats AS (SELECT road_id, CAST(hour(minute) AS INTEGER) AS hour, count(*) AS count, avg(total) AS mean, "
    "var_pop(total) * count(*) AS m2 FROM mt GROUP BY road_id, hour(minute) "
    "UNION ALL SELECT road_id, CAST(NULL AS INTEGER), count(*), avg(total), var_pop(total) * count(*) FROM mt GROUP BY road_id)",
    "meta AS (SELECT road_id, arg_min(coalesce(given_name, road_id), eid) AS road_name, arg_min(region_name, eid) AS region_name, "
    "'' AS region_id, arg_min(local_authority_name, eid) AS local_authority_name, arg_min(road_type, eid) AS road_type "
    "FROM ev WHERE road_id <> '' GROUP BY road_id)",
    "run_road AS (SELECT road_id, road_name, region_name, 'region:' || lower(replace(region_name, ' ', '-')) AS region_id, "
    "local_authority_name, road_type, mean AS baseline_rate_per_minute, count AS observation_count "
    "FROM stats JOIN meta USING (road_id) WHERE hour IS NULL)",
    "run_region AS (SELECT region_id, min(region_name) AS region_name, count(*) AS road_count, "
    "avg(baseline_rate_per_minute) AS baseline_rate_per_minute FROM run_road GROUP BY region_id)",
]

# --- minute series --------------------------------------------------------------------

SERIES_CTES = [
    *EVENTS,
    "sums AS (SELECT region_name, minute, CAST(sum(total_vehicles) AS DOUBLE) AS v FROM ev GROUP BY region_name, minute)",
    "calendar AS (SELECT region_name, unnest(generate_series(min(minute), max(minute), INTERVAL 1 MINUTE)) AS minute "
    "FROM sums GROUP BY region_name)",
    "series AS (SELECT region_name, minute, coalesce(v, 0) AS value FROM calendar LEFT JOIN sums USING (region_name, minute))",
]
