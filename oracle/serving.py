"""Oracle SQL: scoring, analytic queries and operations."""

from __future__ import annotations

from oracle.events import _long_totals
from oracle.parts import EVENTS, FIELDS, GOLD, GOLD_CTES, REGION_CTES, ROAD_CTES, RUN_CTES, SERIES_CTES, gold_ctes, query, region_shares

_WINDOW = 180


def _win(minutes: int) -> str:
    return (
        f"win AS (SELECT * FROM gold WHERE event_timestamp >= "
        f"(SELECT max(event_timestamp) FROM gold) - INTERVAL {minutes} MINUTE)"
    )


WINDOW = [*GOLD_CTES, _win(_WINDOW), "prim AS (SELECT * FROM win WHERE role = 'primary')"]
_PLACE = "region_name, local_authority_name"

# The newest row of a road; a road has one row per minute.
LATEST = [
    *GOLD_CTES,
    f"latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {_PLACE}, road_id "
    "ORDER BY event_timestamp DESC) AS rn FROM gold_road) WHERE rn = 1)",
]
EDGES = [
    *LATEST,
    f"edge AS (SELECT {_PLACE}, least(start_junction_name, end_junction_name) AS src, "
    "greatest(start_junction_name, end_junction_name) AS dst, road_id, event_timestamp, "
    "CASE WHEN link_length_kilometers > 0 THEN link_length_kilometers ELSE 0.1e0 END AS length_km FROM latest)",
    f"edges AS (SELECT {_PLACE}, src, dst, road_id, length_km, 1 / greatest(length_km, 0.1e0) AS weight FROM "
    f"(SELECT *, row_number() OVER (PARTITION BY {_PLACE}, src, dst ORDER BY event_timestamp DESC, road_id DESC) AS rn FROM edge) WHERE rn = 1)",
]

REQUESTS = """req AS (
  SELECT c_custkey AS request_id,
    CASE WHEN c_custkey % 11 = 0 THEN 'road:none-' || c_custkey
         WHEN c_custkey % 2 = 0 THEN 'road:a' || (c_custkey % 50) END AS road_id,
    CASE WHEN c_custkey % 2 = 1 AND c_custkey % 11 <> 0 THEN '  A' || (c_custkey % 50) || ' ' END AS road_name,
    CAST(c_custkey % 24 AS INTEGER) AS hour_of_day,
    CASE c_custkey % 5 WHEN 0 THEN 'northbound' WHEN 1 THEN 'WESTBOUND' WHEN 2 THEN 'nowhere' END AS direction,
    CASE c_custkey % 4 WHEN 0 THEN 0.0e0 WHEN 1 THEN 1.0e0 WHEN 2 THEN 0.5e0 ELSE 2.0e0 END AS scaling_factor
  FROM customer)"""
LOOKED = (
    "looked AS (SELECT req.*, road.road_id AS pid, road.road_name AS pname, road.baseline_rate_per_minute AS baseline "
    "FROM req LEFT JOIN road ON coalesce(req.road_id, 'road:' || lower(trim(req.road_name))) = road.road_id)"
)
_DIRECTION = (
    "dir AS (SELECT road_name, direction AS key, t / sum(t) OVER (PARTITION BY road_name) AS w, "
    "count(*) OVER (PARTITION BY road_name) AS n FROM (SELECT road_name, direction, sum(total) AS t FROM cnt GROUP BY road_name, direction))"
)
_SCORED = """scored AS (SELECT l.*, d.key AS direction_applied,
  greatest(CASE WHEN coalesce(h.mean_per_minute, 0) <> 0 THEN h.mean_per_minute ELSE baseline END, 0) AS rate,
  coalesce(h.std_per_minute, 0) AS std,
  CASE WHEN d.key IS NOT NULL AND d.w * d.n > 0 THEN d.w * d.n ELSE 1.0e0 END
    * CASE WHEN scaling_factor IN (0, 1) THEN 1.0e0 ELSE scaling_factor END AS f
  FROM looked l LEFT JOIN road_hour h ON l.pname = h.road_name AND l.hour_of_day = h.hour
  LEFT JOIN dir d ON l.pname = d.road_name AND lower(l.direction) = lower(d.key))"""

PREDICTIONS = [
    *SERIES_CTES,
    "pred AS (SELECT region_name, minute + to_minutes(lead) AS target_ts, minute AS generated_at, value * (1 + lead / 8.0e0) AS value "
    "FROM series, (SELECT unnest([1, 2, 3]) AS lead))",
    "kept AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY region_name, target_ts ORDER BY generated_at DESC) AS rn "
    f"FROM pred WHERE target_ts >= (SELECT max(generated_at) FROM pred) - INTERVAL {_WINDOW} MINUTE) WHERE rn <= 2)",
]
# Both need the events' CTEs; the running profiles add the expected flow per region.
_FLOW = [
    *RUN_CTES, *SERIES_CTES[len(EVENTS):],
    "tail AS (SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY minute DESC) AS rn FROM series)",
    "last5 AS (SELECT region_name, max(minute) AS lm, arg_max(value, minute) AS lv, arg_min(value, minute) AS fv, count(*) AS n "
    "FROM tail WHERE rn <= 5 GROUP BY region_name)",
    "fc AS (SELECT region_name, lm + to_minutes(m) AS target_ts, greatest((1 - m / 5.0e0) * (lv + (lv - fv) / greatest(n - 1, 1) * m) "
    "+ m / 5.0e0 * baseline_rate_per_minute, 0) AS value FROM last5 JOIN run_region USING (region_name), (SELECT unnest([1, 2, 3, 4, 5]) AS m))",
]


def _top(measure: str, name: str) -> str:
    return (
        f"SELECT {_PLACE}, road_name, {name} FROM (SELECT *, row_number() OVER (PARTITION BY {_PLACE} ORDER BY {name} DESC, road_name) AS rn "
        f"FROM (SELECT {_PLACE}, road_name, {measure} AS {name} FROM gold_road GROUP BY {_PLACE}, road_name)) WHERE rn <= 12"
    )


_HUMAN = """CASE WHEN {s} IS NULL OR {s} < 0 THEN NULL WHEN {s} < 1 THEN '<1s' ELSE concat_ws(' ',
  {day}
  CASE WHEN {h} > 0 THEN ({h}) || 'h' END,
  CASE WHEN CAST(floor({s}) AS BIGINT) // 60 % 60 > 0 THEN (CAST(floor({s}) AS BIGINT) // 60 % 60) || 'm' END,
  (CAST(floor({s}) AS BIGINT) % 60) || 's') END"""


def humanized(s: str, days: bool = True) -> str:
    hours = f"CAST(floor({s}) AS BIGINT) // 3600"
    day = f"CASE WHEN CAST(floor({s}) AS BIGINT) // 86400 > 0 THEN (CAST(floor({s}) AS BIGINT) // 86400) || 'd' END," if days else ""
    return _HUMAN.format(s=s, h=f"{hours} % 24" if days else hours, day=day)


def sized(s: str, sep: str) -> str:
    steps = " ".join(
        f"WHEN {s} < {1024 ** (i + 1)}::DOUBLE THEN format('{{:.1f}}', {s} / {1024 ** i}::DOUBLE) || '{sep}{u}'"
        for i, u in enumerate(("B", "KB", "MB", "GB", "TB"))
    )
    return f"CASE {steps} ELSE format('{{:.1f}}', {s} / {1024 ** 5}::DOUBLE) || '{sep}PB' END"


_SHARES = tuple(zip(FIELDS, GOLD))[:5]
_EXPECTED = [
    *REGION_CTES,
    "grid AS (SELECT unnest(generate_series(0, 23)) AS hour)",
    f"share AS ({region_shares('road_name')})",
    "w AS (SELECT r.region_name, g.hour, r.road_id, "
    "greatest(coalesce(h.mean_per_minute, r.baseline_rate_per_minute), 0.001e0) * greatest(coalesce(s.weight, 1.0e0), 0.001e0) AS w "
    "FROM road r CROSS JOIN grid g LEFT JOIN road_hour h ON h.road_name = r.road_name AND h.hour = g.hour "
    "LEFT JOIN share s ON s.region_name = r.region_name AND s.key = r.road_name)",
    "rr AS (SELECT region_name, g.hour, greatest(r.baseline_rate_per_minute, 0.05e0) AS base, "
    "greatest(coalesce(h.mean_per_minute, greatest(r.baseline_rate_per_minute, 0.05e0)), greatest(r.baseline_rate_per_minute, 0.05e0), 0.1e0) AS mean "
    "FROM region_row r CROSS JOIN grid g LEFT JOIN region_hour h USING (region_name, hour))",
    "rate AS (SELECT *, greatest(mean, 0.75e0 * mean, 0.75e0 * base, 10.0e0) AS region_rate FROM rr)",
]

SERVING_QUERIES = {
    "lookup_profile": query(*ROAD_CTES, REQUESTS, LOOKED, select="""SELECT request_id, road_id, road_name, hour_of_day, direction,
      scaling_factor, pname AS profile_road_name, round(baseline, 6) AS baseline, pid AS profile_road_id,
      CASE WHEN pid IS NULL THEN 'not_found' ELSE 'ok' END AS status FROM looked"""),
    "predict": query(*ROAD_CTES, REQUESTS, LOOKED, _DIRECTION, _SCORED, select="""SELECT request_id, direction, scaling_factor,
      CASE WHEN pid IS NULL THEN 'not_found' ELSE 'ok' END AS status, coalesce(road_id, pid) AS road_id,
      coalesce(pname, road_name, road_id) AS road_name, hour_of_day,
      round(rate * f, 6) AS expected_flow_per_minute, round(greatest(rate - 2 * std, 0) * f, 6) AS lower_bound_per_minute,
      round((rate + 2 * std) * f, 6) AS upper_bound_per_minute, round(rate * f * 60, 6) AS expected_flow_per_hour,
      direction_applied, CASE WHEN std > 0 THEN 'medium' ELSE 'low' END AS confidence_level FROM scored WHERE pid IS NOT NULL
      UNION ALL SELECT request_id, direction, scaling_factor, 'not_found', road_id, coalesce(road_name, road_id), hour_of_day,
      NULL, NULL, NULL, NULL, NULL, NULL FROM scored WHERE pid IS NULL"""),
    "scaling_factor": query(*SERIES_CTES, select="""SELECT region_name, round(CASE WHEN m > 0 THEN greatest(least(l / m, 2.5e0), 0.25e0)
      ELSE 1.0e0 END, 6) AS scaling_factor FROM (SELECT region_name, avg(value) AS m, arg_max(value, minute) AS l FROM
      (SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY minute DESC) AS rn FROM series) WHERE rn <= 12 GROUP BY region_name)"""),
    "forecast_5min": query(*_FLOW, select="SELECT region_name, target_ts, round(value, 6) AS value FROM fc"),
    "prediction_history": query(*PREDICTIONS, select="""SELECT region_name, target_ts, round(arg_max(value, generated_at), 6) AS value,
      max(generated_at) AS generated_at, count(*) AS kept FROM kept GROUP BY region_name, target_ts"""),
    "worst_prediction": query(*PREDICTIONS, select="""SELECT region_name, minute, round(p, 6) AS worst_prediction, observed,
      round(err, 6) AS absolute_error FROM (SELECT s.region_name, s.minute, k.value AS p, s.value AS observed, abs(s.value - k.value) AS err,
      row_number() OVER (PARTITION BY s.region_name, s.minute ORDER BY abs(s.value - k.value) DESC, k.generated_at) AS rn
      FROM series s JOIN kept k ON s.region_name = k.region_name AND s.minute = k.target_ts) WHERE rn = 1"""),
    "normalise_weights": """SELECT c_mktsegment, c_custkey, round(c_acctbal / sum(c_acctbal) OVER (PARTITION BY c_mktsegment), 6) AS weight
      FROM customer WHERE c_acctbal > 0 AND c_custkey % 13 <> 0""",
    "complete_hour_profile": query(
        *RUN_CTES,
        "hrs AS (SELECT road_id, hour, mean, CASE WHEN hour % 2 = 0 THEN sqrt(greatest(m2 / count, 0)) END AS std, count "
        "FROM stats WHERE hour IS NOT NULL AND count >= 20)",
        "b AS (SELECT road_id, baseline_rate_per_minute AS base, greatest(baseline_rate_per_minute * 0.1e0, 0.01e0) AS spread FROM run_road)",
        select="""SELECT road_id, hour, round(mean, 6) AS mean_per_minute, round(abs(coalesce(std, spread)), 6) AS std_per_minute,
      count AS observations FROM hrs JOIN b USING (road_id)
      UNION ALL SELECT road_id, CAST(h AS INTEGER), round(base, 6), round(spread, 6), 0 FROM b, (SELECT unnest(generate_series(0, 23)) AS h)
      WHERE road_id NOT IN (SELECT road_id FROM hrs)""",
    ),
    "expected_road_rate": query(*_EXPECTED, select="""SELECT region_name, road_id, CAST(hour AS INTEGER) AS hour, round(p, 6) AS probability,
      round(region_rate, 6) AS region_rate, round(greatest(region_rate * p, 0.25e0 * region_rate, 2.0e0), 6) AS road_rate
      FROM (SELECT *, w / sum(w) OVER (PARTITION BY region_name, hour) AS p FROM w) JOIN rate USING (region_name, hour)"""),
    # analytics
    "trailing_window": query(*GOLD_CTES, _win(15), select=f"""SELECT role, {_PLACE}, road_id, event_timestamp, total_vehicles,
      round(vehicles_per_km, 6) AS vehicles_per_km FROM win"""),
    "split_by_role": query(*GOLD_CTES, select=f"SELECT role AS subset, role, {_PLACE}, road_id, event_timestamp, total_vehicles FROM gold"),
    "window_kpis": query(*WINDOW, select="""SELECT (SELECT count(*) FROM prim) AS row_count,
      (SELECT CAST(sum(total_vehicles) AS BIGINT) FROM prim) AS total_vehicles, round((SELECT sum(total_vehicles) FROM prim) /
      (SELECT sum(l) FROM (SELECT max(total_link_length_km) AS l FROM prim GROUP BY region_name)), 6) AS vehicles_per_km"""),
    "region_totals": query(*WINDOW, select="SELECT region_name, CAST(sum(total_vehicles) AS BIGINT) AS total_vehicles FROM prim GROUP BY region_name"),
    "region_density": query(*WINDOW, select="""SELECT region_name, round(CASE WHEN max(total_link_length_km) > 0
      THEN sum(total_vehicles) / max(total_link_length_km) ELSE 0 END, 6) AS vehicles_per_km FROM prim GROUP BY region_name"""),
    "minute_series": query(
        *GOLD_CTES,
        "m AS (SELECT event_timestamp AS minute, CAST(sum(total_vehicles) AS DOUBLE) AS v FROM gold WHERE role <> 'authority' GROUP BY event_timestamp)",
        select="""SELECT minute, coalesce(v, 0) AS value FROM (SELECT unnest(generate_series(
      greatest(min(minute), max(minute) - INTERVAL 1439 MINUTE), max(minute), INTERVAL 1 MINUTE)) AS minute FROM m) LEFT JOIN m USING (minute)""",
    ),
    "density_series": query(*WINDOW, select="""SELECT event_timestamp AS minute, region_name, round(avg(vehicles_per_km), 6) AS vehicles_per_km
      FROM prim GROUP BY event_timestamp, region_name ORDER BY event_timestamp DESC, region_name DESC"""),
    "vehicle_share": query(*WINDOW, select=_long_totals("prim", "", _SHARES)),
    "region_breakdown": query(*WINDOW, select=_long_totals("prim", "region_name")),
    "authority_breakdown": query(*WINDOW, "auth AS (SELECT * FROM win WHERE role = 'authority')", select=_long_totals("auth", _PLACE)),
    "authority_totals": query(*WINDOW, select=f"""SELECT {_PLACE}, CAST(sum(total_vehicles) AS BIGINT) AS total_vehicles FROM win
      WHERE role = 'authority' GROUP BY {_PLACE}"""),
    "top_roads_by_volume": query(*GOLD_CTES, select=_top("CAST(sum(total_vehicles) AS BIGINT)", "total_vehicles")),
    "top_roads_by_density": query(*GOLD_CTES, select=f"""SELECT {_PLACE}, road_name, round(vehicles_per_km, 6) AS vehicles_per_km
      FROM ({_top("round(avg(vehicles_per_km), 9)", "vehicles_per_km")})"""),
    "busiest_road": query(
        *RUN_CTES, *gold_ctes(), _win(_WINDOW),
        "roads AS (SELECT *, CASE WHEN minute(event_timestamp) % 5 <> 0 THEN 'D' || (minute(event_timestamp) % 4) END AS direction "
        "FROM win WHERE role = 'road')",
        "top AS (SELECT road_id, CAST(sum(total_vehicles) AS BIGINT) AS total_vehicles FROM roads GROUP BY road_id "
        "ORDER BY total_vehicles DESC, road_id LIMIT 1)",
        select="""SELECT CASE WHEN top.road_id IN (SELECT road_id FROM run_road) THEN top.road_id
      ELSE (SELECT min(road_id) FROM run_road) END AS road_id, top.road_id AS observed_road_id, top.total_vehicles,
      (SELECT direction FROM roads r WHERE r.road_id = top.road_id AND direction IS NOT NULL ORDER BY event_timestamp DESC, direction DESC LIMIT 1) AS direction FROM top""",
    ),
    "latest_per_road": query(*LATEST, select=f"""SELECT {_PLACE}, road_id, road_name, event_timestamp, total_vehicles,
      start_junction_name, end_junction_name, round(link_length_kilometers, 6) AS link_length_kilometers FROM latest"""),
    "road_edges": query(*EDGES, select=f"SELECT {_PLACE}, src, dst, road_id, round(length_km, 6) AS length_km, round(weight, 6) AS weight FROM edges"),
    "road_nodes": query(*EDGES, select=f"SELECT {_PLACE}, src AS junction FROM edges UNION SELECT {_PLACE}, dst FROM edges"),
    "load_ratio": query(
        *LATEST,
        f"span AS (SELECT *, min(total_vehicles) OVER (PARTITION BY {_PLACE}) AS lo, max(total_vehicles) OVER (PARTITION BY {_PLACE}) AS hi FROM latest)",
        f"ratios AS (SELECT {_PLACE}, road_id, road_name, CAST(total_vehicles AS DOUBLE) AS total_vehicles, "
        "CASE WHEN hi > lo THEN (total_vehicles - lo) / (hi - lo) ELSE 0.5e0 END AS ratio FROM span)",
        select=f"SELECT {_PLACE}, road_id, road_name, total_vehicles, round(ratio, 6) AS ratio, round(2 + 4 * ratio, 6) AS width FROM ratios",
    ),
    "batch_increment": query(*EVENTS, *gold_ctes(batch=True), select="""SELECT batch_id, CAST(sum(total_vehicles) AS BIGINT) AS vehicles_new,
      round(sum(total_vehicles) / count(DISTINCT region_name), 6) AS vehicles_avg_region FROM gold WHERE role <> 'authority'
      GROUP BY batch_id HAVING sum(total_vehicles) > 0 ORDER BY batch_id DESC"""),
    "recent_records": query(*GOLD_CTES, select="""SELECT event_timestamp, region_name, local_authority_name, road_name, road_type,
      round(total_link_length_km, 6) AS total_link_length_km, round(coalesce(link_length_kilometers, 0), 6) AS link_length_kilometers,
      total_vehicles, heavy_vehicles, round(vehicles_per_km, 6) AS vehicles_per_km FROM gold
      ORDER BY event_timestamp DESC, role, region_name, local_authority_name NULLS FIRST, road_id NULLS FIRST"""),
    "history_append_prune": query(*GOLD_CTES, _win(_WINDOW), select=f"SELECT role, {_PLACE}, road_id, event_timestamp, total_vehicles FROM win"),
    "prefer_root": query(*GOLD_CTES, select=f"""SELECT role, {_PLACE}, road_id, event_timestamp, total_vehicles,
      CAST(CASE WHEN hour(event_timestamp) < 6 THEN 0 ELSE 1 END AS INTEGER) AS source_root FROM gold"""),
    # Every batch of both roots once: all partial rows.
    "failover_union": query(*EVENTS, *gold_ctes(batch=True), select=f"SELECT role, {_PLACE}, road_id, event_timestamp, batch_id, total_vehicles FROM gold"),
    "validated_mix": query(*ROAD_CTES, _DIRECTION, select="""SELECT road_id, key, round(w, 6) AS weight FROM dir JOIN road USING (road_name)
      WHERE road_id NOT LIKE '%3' UNION ALL SELECT road_id, 'Unknown', 1.0e0 FROM road WHERE road_id LIKE '%3'"""),
    "road_ids": query(*RUN_CTES, select="SELECT DISTINCT road_id FROM run_road ORDER BY road_id"),
    "road_count": query(*RUN_CTES, select="SELECT count(DISTINCT road_id) AS road_count FROM run_road"),
    "chart_union": query(*_FLOW, select="""SELECT region_name, minute AS ts, 'observed' AS series, value FROM series
      UNION ALL SELECT region_name, target_ts, 'predicted', round(value, 6) FROM fc"""),
    # operations
    "pipeline_freshness": query(
        *EVENTS,
        "log AS (SELECT 'pipeline-' || lower(region_name) AS component, batch_id, CAST(epoch(max(minute)) AS DOUBLE) AS flush, "
        "count(*) AS total_events, count(DISTINCT road_key) AS gold_records FROM ev GROUP BY region_name, batch_id)",
        "last AS (SELECT *, 1704110700 - flush AS lag FROM (SELECT *, row_number() OVER (PARTITION BY component "
        "ORDER BY flush DESC, batch_id DESC) AS rn FROM log) WHERE rn = 1)",
        f"shown AS (SELECT *, {humanized('lag')} AS human_lag FROM last)",
        select="""SELECT component, 'pipeline' AS category, CASE WHEN lag > 180 THEN 'delayed' ELSE 'ok' END AS status,
      lag AS lag_seconds, total_events, gold_records, human_lag,
      'Lag: ' || coalesce(human_lag, 'N/D') || ' | Events: ' || total_events || ' | Gold records: ' || gold_records AS summary,
      strftime(make_timestamp(CAST(flush * 1000000 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS updated_at FROM shown""",
    ),
    "component_metrics": f"""WITH c AS (SELECT p_partkey AS k, p_size FROM part)
      SELECT 'component-' || k AS component,
        CASE WHEN k % 3 = 0 THEN 'restarted' WHEN p_size > 40 THEN 'delayed' ELSE 'ok' END AS status,
        CASE WHEN k % 5 = 0 THEN 'now' ELSE {humanized("(k * 37.0e0)", days=False)} END AS latency,
        {sized("(k * 1536.0e0)", " ")} AS memory,
        CASE WHEN k % 2 = 0 THEN k || ' rows' ELSE CAST(k AS VARCHAR) END AS storage,
        CASE WHEN k % 4 <> 0 THEN (k % 100) || '.2%' WHEN k % 8 = 0 THEN format('{{:.1f}}%', p_size / 2.0e0) ELSE 'N/D' END AS cpu
      FROM c WHERE k % 7 <> 0""",
    "display_texts": f"""WITH t AS (SELECT p_partkey, (p_partkey * 977 - 500) / 4.0e0 AS s, CAST(p_partkey * p_partkey * 1280 AS DOUBLE) AS b FROM part)
      SELECT p_partkey, {humanized("s")} AS humanized, coalesce({humanized("s", days=False)}, 'N/D') AS lag,
        {sized("b", "")} AS bytes, CASE WHEN b < 100000 THEN 'N/D' ELSE {sized("(b - 100000)", " ")} END AS size,
        CASE WHEN b * 4 - 5120 <= 0 THEN 'N/D' ELSE {sized("b", " ")} || ' / ' || {sized("(b * 4 - 5120)", " ")}
          || ' (' || format('{{:.1f}}', b / (b * 4 - 5120) * 100) || '%)' END AS usage
      FROM t""",
}
