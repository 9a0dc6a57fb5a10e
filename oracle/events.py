"""Oracle SQL: events, gold roll-ups and running profiles."""

from __future__ import annotations

from oracle.parts import (
    EVENTS, FIELDS, FIRST_KNOWN, GOLD, GOLD_CTES, GOLD_OUT, KEYS, MAX_LEN, RUN_CTES, SRC, classes, cols,
    gold_ctes, query,
)

# One unit past the text of the total: quoted with blanks reads as the number, a quoted
# fraction is no whole number, a bare fraction is cut, a word is nothing.
_WHOLE = "CASE WHEN eid % 13 IN (1, 3) THEN 0 ELSE v END"
_REAL = (
    "CASE WHEN eid % 13 = 1 THEN v + 0.5e0 WHEN eid % 13 = 2 THEN v + 0.75e0 "
    "WHEN eid % 13 = 3 THEN 0.0e0 ELSE CAST(v AS DOUBLE) END"
)
_SECOND = "date_trunc('second', ts)"
# Times carry whole seconds; unreadable ones take the ingest time, bare dates midnight.
_TIME = f"""CASE WHEN eid % 17 = 1 THEN date_trunc('hour', ts)
  WHEN eid % 17 = 4 THEN date_trunc('day', ts) ELSE {_SECOND} END"""

_PARSED = f"""parsed AS (
  SELECT eid, ts, r_name, n_name, uid, k, v, event_type,
    CASE WHEN eid % 37 <> 0 THEN 'road:' || (uid % 40) ELSE '' END AS road_id,
    CASE WHEN eid % 23 <> 0 THEN 'Road ' || (uid % 40) END AS given_name,
    CASE WHEN uid % 10 = 3 THEN 'Unknown start' WHEN uid % 9 <> 0 THEN 'J' || (uid % 12) END AS s,
    CASE WHEN uid % 9 <> 1 THEN 'J' || (uid % 7) END AS e,
    {_TIME} AS event_ts
  FROM src WHERE eid % 53 <> 0 AND eid % 59 <> 0)"""

_NORMALISE = query(
    SRC, _PARSED,
    """named AS (SELECT *, coalesce(given_name, 'Unknown road') AS road_name,
      coalesce(s, coalesce(given_name, 'Unknown road') || ' (inicio)') AS start_junction,
      coalesce(e, coalesce(given_name, 'Unknown road') || ' (fin)') AS e2 FROM parsed)""",
    "joined AS (SELECT *, CASE WHEN start_junction = e2 THEN e2 || ' (fin)' ELSE e2 END AS end_junction FROM named)",
    select=f"""SELECT 'traffic.raw' AS topic, CAST(0 AS INTEGER) AS partition, eid AS "offset",
  date_trunc('hour', ts) AS ingest_ts, CAST(eid AS VARCHAR) AS event_id,
  r_name AS region_name, n_name AS local_authority_name, road_id, road_name,
  CASE WHEN uid % 3 = 0 THEN 'Minor' ELSE 'Major' END AS road_type, start_junction, end_junction,
  event_ts, date_trunc('minute', event_ts) AS minute,
  round(CASE WHEN k > 0 THEN k / 10.0e0 WHEN eid % 5 <> 0 THEN k / 16.0e0 * 1.60934e0 ELSE 0 END, 6) AS link_length_km,
  CAST({_WHOLE} AS BIGINT) AS total_vehicles,
  CAST(CASE WHEN eid % 4 <> 0 THEN eid % 3 ELSE 0 END AS BIGINT) AS heavy_vehicles,
  {classes(GOLD, "CAST(CASE WHEN eid % 11 = {i} THEN v + 1 ELSE 0 END AS BIGINT) AS {n}")},
  round(CASE WHEN {_REAL} > 0 THEN {_REAL} ELSE v + 1 END, 6) AS vehicle_count,
  CASE event_type WHEN 'click' THEN 'N' WHEN 'view' THEN 'S' WHEN 'purchase' THEN 'E' WHEN 'signup' THEN 'W' END AS direction,
  coalesce(given_name, road_id) AS meta_road_name, r_name AS meta_region_name, '' AS meta_region_id,
  n_name AS meta_local_authority_name, CASE WHEN uid % 3 = 0 THEN 'Minor' ELSE 'Major' END AS meta_road_type,
  CASE WHEN road_id <> '' THEN road_id ELSE road_name || ':' || start_junction || '->' || end_junction END AS road_key,
  eid AS arrival
FROM joined""",
)

_MERGED = query(*GOLD_CTES, select=f"SELECT {GOLD_OUT} FROM gold")

_FOREIGN = f"""SELECT role, region_name, local_authority_name, road_id,
  strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S+00:00') AS timestamp, event_timestamp,
  CAST(total_vehicles AS VARCHAR) AS all_motor_vehicles, heavy_vehicles AS all_hgvs,
  round(total_link_length_km, 6) AS total_link_length_km, total_vehicles, heavy_vehicles,
  round(CASE WHEN total_link_length_km > 0 THEN total_vehicles / total_link_length_km ELSE 0 END, 6) AS vehicles_per_km,
  pedal_cycles AS pedal_cycle_total, pedal_cycles AS pedal_cycle_count, cars_and_taxis AS car_and_taxi_count
FROM gold"""

_CLASS_ROWS = " UNION ALL ".join(
    f"SELECT role, region_name, local_authority_name, road_id, event_timestamp, '{k}' AS vehicle_class, {g} AS count FROM gold"
    for k, g in zip(KEYS, GOLD)
)


def _long_totals(source: str, by: str, fields=tuple(zip(FIELDS, GOLD))) -> str:
    """Vehicles per class as long rows."""
    keys = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {keys}'{f}' AS vehicle_class, CAST(coalesce(sum({g}), 0) AS BIGINT) AS total FROM {source}{group}"
        for f, g in fields
    )


EVENT_QUERIES = {
    "normalise_events": _NORMALISE,
    "silver_keys": query(*EVENTS, select="""SELECT CAST(eid AS VARCHAR) AS event_id,
      trim(regexp_replace(lower(region_name), '[^a-z0-9]+', '-', 'g'), '-') AS region_slug,
      strftime(ts, '%Y%m%d') AS dt, strftime(ts, '%H') AS hour FROM ev"""),
    "unpivot_classes": query(*GOLD_CTES, select=_CLASS_ROWS),
    "gold_region": query(*GOLD_CTES, select=f"SELECT {GOLD_OUT} FROM gold_primary"),
    "gold_authority": query(*GOLD_CTES, select=f"SELECT {GOLD_OUT} FROM gold_authority"),
    "gold_road": query(*GOLD_CTES, select=f"SELECT {GOLD_OUT} FROM gold_road"),
    "gold_all": _MERGED,
    # Compacting the per-batch rows must give back the roll-up of all events.
    "merge_gold_partials": _MERGED,
    "distinct_link_length": query(*EVENTS, select=f"""SELECT region_name, minute,
      round(coalesce(sum(len), 0), 6) AS total_link_length_km, count(len) AS roads_measured
      FROM (SELECT region_name, road_key, minute, {MAX_LEN} FROM ev GROUP BY region_name, road_key, minute)
      GROUP BY region_name, minute"""),
    "first_known_descriptor": query(*EVENTS, select=f"""SELECT region_name, local_authority_name, road_key, minute,
      road_name, road_type, start_junction_name AS start_junction, end_junction_name AS end_junction
      FROM (SELECT region_name, local_authority_name, road_key, minute, {FIRST_KNOWN}
      FROM ev GROUP BY region_name, local_authority_name, road_key, minute)"""),
    "normalise_gold": query(*GOLD_CTES, select=_FOREIGN),
    "vehicle_mix_totals": query(*GOLD_CTES, select=_long_totals("gold_primary", "")),
    "minute_totals": query(*RUN_CTES, select="SELECT road_id, minute, total FROM mt"),
    "welford_single_batch": query(*RUN_CTES, select="SELECT road_id, hour, count, round(mean, 6) AS mean, round(m2, 6) AS m2 FROM stats"),
    # The merged state over batches equals one pass over all their observations.
    "welford_merge": query(
        *EVENTS,
        "obs AS (SELECT batch_id, road_id, minute, sum(vehicle_count) AS total FROM ev WHERE road_id <> '' GROUP BY batch_id, road_id, minute)",
        select="""SELECT road_id, CAST(hour(minute) AS INTEGER) AS hour, count(*) AS count, round(avg(total), 6) AS mean,
          round(var_pop(total) * count(*), 6) AS m2 FROM obs GROUP BY road_id, hour(minute)
          UNION ALL SELECT road_id, CAST(NULL AS INTEGER), count(*), round(avg(total), 6), round(var_pop(total) * count(*), 6)
          FROM obs GROUP BY road_id""",
    ),
    "direction_counts": query(*EVENTS, select="""SELECT road_id, direction,
      CAST(sum(greatest(CAST(round_even(vehicle_count, 0) AS BIGINT), 1)) AS BIGINT) AS count
      FROM ev WHERE road_id <> '' AND direction IS NOT NULL GROUP BY road_id, direction"""),
    # The first value that is not empty over the batches; every second batch knows no road type.
    "merge_metadata": query(
        *EVENTS,
        "per_batch AS (SELECT road_id, batch_id, arg_min(coalesce(given_name, road_id), eid) AS road_name, "
        "arg_min(region_name, eid) AS region_name, arg_min(local_authority_name, eid) AS local_authority_name, "
        "CASE WHEN batch_id % 2 = 1 THEN arg_min(road_type, eid) ELSE '' END AS road_type "
        "FROM ev WHERE road_id <> '' GROUP BY road_id, batch_id)",
        select="""SELECT road_id, arg_min(road_name, batch_id) AS road_name, arg_min(region_name, batch_id) AS region_name, '' AS region_id,
      arg_min(local_authority_name, batch_id) AS local_authority_name,
      coalesce(arg_min(road_type, batch_id) FILTER (WHERE road_type <> ''), '') AS road_type FROM per_batch GROUP BY road_id""",
    ),
    "runtime_road_profile": query(*RUN_CTES, select="""SELECT road_id, road_name, region_name, region_id, local_authority_name,
      road_type, round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute, observation_count FROM run_road"""),
    "runtime_hours": query(*RUN_CTES, select="""SELECT road_id, hour, round(mean, 6) AS mean_per_minute,
      round(sqrt(greatest(m2 / count, 0)), 6) AS std_per_minute, count AS observations FROM stats
      WHERE hour IS NOT NULL AND count >= 3"""),
    "runtime_direction_mix": query(
        *EVENTS,
        "d AS (SELECT road_id, direction, sum(greatest(CAST(round_even(vehicle_count, 0) AS BIGINT), 1)) AS c "
        "FROM ev WHERE road_id <> '' AND direction IS NOT NULL GROUP BY road_id, direction)",
        select="SELECT road_id, direction AS key, round(c / sum(c) OVER (PARTITION BY road_id), 6) AS weight FROM d",
    ),
    "runtime_region_profile": query(*RUN_CTES, select="""SELECT region_id, region_name, road_count,
      round(baseline_rate_per_minute, 6) AS baseline_rate_per_minute FROM run_region"""),
}
