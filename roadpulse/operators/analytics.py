"""Analytic queries over gold records (``records.normalise_gold``).

Where the interactive use picks one region, authority or road, these answer every
group in one job: pass ``by``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.aggregates import last_rows, unpivot
from roadpulse.functions.measures import ratio_or_zero
from roadpulse.functions.parsing import minute_bucket
from roadpulse.schemas import CLASS_FIELDS

LIVE_MINUTES = 15
HISTORY_MINUTES = 1440
TS = "event_timestamp"
# The class columns of the share view, and the columns of the recent view.
SHARE_FIELDS = (
    "pedal_cycle_count", "two_wheeled_motor_vehicle_count", "car_and_taxi_count", "bus_and_coach_count",
    "light_goods_vehicle_count", "all_heavy_goods_vehicle_count",
)
RECENT_COLUMNS = (
    "event_timestamp", "region_name", "local_authority_name", "road_name", "road_type",
    "total_link_length_km", "link_length_kilometers", "total_vehicles", "heavy_vehicles", "vehicles_per_km",
)


def trailing_window(records: DataFrame, minutes: int, *, ts: str = TS) -> DataFrame:
    """Rows no older than ``minutes`` before the newest row; all rows for 0 or less.

    The cutoff is a scalar subquery: a one-column scan, evaluated before the filter runs.
    """
    if minutes <= 0:
        return records
    cutoff = records.agg((F.max(ts) - F.make_dt_interval(mins=F.lit(minutes))).alias("cutoff")).scalar()
    # Without any time stamp the cutoff is null and every row stays.
    return records.where((F.col(ts) >= cutoff) | cutoff.isNull())


def by_role(records: DataFrame, role: str) -> DataFrame:
    """One subset; ``primary`` falls back to all rows when there are none."""
    if role != "primary":
        return records.where(F.col("role") == role)
    primaries = records.where(F.col("role") == "primary").limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    return records.where((F.col("role") == "primary") | (primaries == 0))


def split_by_role(records: DataFrame) -> dict[str, DataFrame]:
    return {r: by_role(records, r) for r in ("authority", "primary", "road")}


def window_kpis(records: DataFrame) -> DataFrame:
    """Rows, vehicles and density; the density uses each region's longest length."""
    per_region = records.groupBy("region_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_vehicles").alias("total"),
        F.coalesce(F.max("total_link_length_km"), F.lit(0.0)).alias("length"),
        F.sum("vehicles_per_km").alias("density_sum"),
        F.count("vehicles_per_km").alias("density_n"),
    )
    totals = per_region.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_vehicles"),
        F.sum("length").alias("length"),
        (F.sum("density_sum") / F.nullif(F.sum("density_n"), F.lit(0))).alias("mean_density"),
    )
    density = F.when(F.col("length") > 0, F.col("total_vehicles") / F.col("length")).otherwise(F.col("mean_density"))
    return totals.select("row_count", "total_vehicles", F.coalesce(density, F.lit(0.0)).alias("vehicles_per_km"))


def region_totals(records: DataFrame) -> DataFrame:
    return records.groupBy("region_name").agg(F.sum("total_vehicles").alias("total_vehicles")).orderBy(
        F.desc("total_vehicles"), "region_name"
    )


def region_density(records: DataFrame) -> DataFrame:
    if "total_link_length_km" in records.columns:
        density = F.coalesce(
            ratio_or_zero(F.sum("total_vehicles"), F.max("total_link_length_km")), F.lit(0.0)
        )
    else:
        density = F.avg("vehicles_per_km")
    return records.groupBy("region_name").agg(density.alias("vehicles_per_km")).orderBy(
        F.desc("vehicles_per_km"), "region_name"
    )


def minute_series(
    records: DataFrame, by: Sequence[str] = (), *, rows: Column | None = None, minutes: int = 0
) -> DataFrame:
    """Vehicles per minute with the empty minutes between the first and the last as 0.

    ``rows`` picks the records (default: all but authority rows, so region and road rows
    both count); ``minutes`` keeps only the newest minutes of the result.
    """
    picked = records.where((F.col("role") != "authority") if rows is None else rows)
    # Also what the join below would ask of its right side only, so that both sides stay one exchange.
    picked = picked.where(F.col(TS).isNotNull() & minute_bucket(F.col(TS)).isNotNull())
    observed = picked.groupBy(*by, minute_bucket(F.col(TS)).alias("minute")).agg(
        F.sum("total_vehicles").cast("double").alias("value")
    )
    return fill_minutes(observed, by, minutes=minutes)


def fill_minutes(observed: DataFrame, by: Sequence[str] = (), *, minutes: int = 0) -> DataFrame:
    """A calendar of whole days first, minutes second: no single array spans the range."""
    first = F.min("minute")
    if minutes > 0:
        first = F.greatest(first, F.max("minute") - F.make_dt_interval(mins=F.lit(minutes - 1)))
    # The count keeps the value column here too, so that both uses of ``observed`` are one exchange.
    bounds = observed.groupBy(*by).agg(first.alias("_lo"), F.max("minute").alias("_hi"), F.count("value").alias("_n"))
    day = F.expr("interval 1 day")
    days = bounds.where(F.col("_lo").isNotNull() & (F.col("_n") >= 0)).withColumn(
        "_day", F.explode(F.sequence(F.date_trunc("day", "_lo"), F.col("_hi"), day))
    )
    calendar = days.select(
        *by,
        F.explode(F.sequence(
            F.greatest("_day", "_lo"),
            F.least(F.col("_day") + F.expr("interval 1439 minutes"), F.col("_hi")),
            F.expr("interval 1 minute"),
        )).alias("minute"),
    )
    return calendar.join(observed, [*by, "minute"], "left").select(
        *by, "minute", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def density_series(records: DataFrame, *, minutes: int = 0) -> DataFrame:
    """Mean density per minute and region, newest first; ``minutes`` keeps the newest ones."""
    rows = trailing_window(records.where(F.col(TS).isNotNull() & F.col("region_name").isNotNull()), minutes)
    return (
        rows.groupBy(minute_bucket(F.col(TS)).alias("minute"), "region_name")
        .agg(F.avg("vehicles_per_km").alias("vehicles_per_km"))
        .orderBy(F.desc("minute"), F.desc("region_name"))
    )


def vehicle_mix_totals(
    records: DataFrame, by: Sequence[str] = (), *, fields: Sequence[str] = CLASS_FIELDS
) -> DataFrame:
    """Vehicles per class (those of ``fields`` the records have), per group."""
    present = [f for f in fields if f in records.columns]
    sums = records.groupBy(*by).agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in present])
    return unpivot(sums, by, {f: F.col(f) for f in present}, "vehicle_class", "total").orderBy(
        *by, F.desc("total"), "vehicle_class"
    )


def vehicle_share(records: DataFrame) -> DataFrame:
    return vehicle_mix_totals(records, fields=SHARE_FIELDS)


def region_breakdown(records: DataFrame) -> DataFrame:
    return vehicle_mix_totals(records, ["region_name"])


def authority_breakdown(records: DataFrame) -> DataFrame:
    rows = records.where(F.col("role") == "authority")
    return vehicle_mix_totals(rows, ["region_name", "local_authority_name"])


def authority_totals(records: DataFrame) -> DataFrame:
    rows = records.where((F.col("role") == "authority") & F.col("local_authority_name").isNotNull())
    return rows.groupBy("region_name", "local_authority_name").agg(
        F.sum("total_vehicles").alias("total_vehicles")
    ).orderBy("region_name", F.desc("total_vehicles"), "local_authority_name")


def _top_roads(records: DataFrame, measure: Column, name: str, k: int, by: Sequence[str]) -> DataFrame:
    rows = records.where((F.col("role") == "road") & F.col("road_name").isNotNull())
    ranked = rows.groupBy(*by, "road_name").agg(measure.alias(name))
    return last_rows(ranked, by, [F.desc(name), F.asc("road_name")], k)


def top_roads_by_volume(records: DataFrame, k: int = 12, by: Sequence[str] = ("region_name", "local_authority_name")) -> DataFrame:
    """The busiest roads of every group. Tasks cut to ``k`` rows per group before the shuffle."""
    return _top_roads(records, F.sum("total_vehicles"), "total_vehicles", k, by)


def top_roads_by_density(records: DataFrame, k: int = 12, by: Sequence[str] = ("region_name", "local_authority_name")) -> DataFrame:
    # Ranked on the value as reported, so that ulp noise does not order ties.
    return _top_roads(records, F.round(F.avg("vehicles_per_km"), 9), "vehicles_per_km", k, by)


def busiest_road(records: DataFrame, known: DataFrame, *, minutes: int = LIVE_MINUTES) -> DataFrame:
    """The road with most vehicles in the window and its latest direction.

    A road the profiles do not know gives way to the first known road.
    """
    window = trailing_window(records, minutes).where((F.col("role") == "road") & F.col("road_id").isNotNull())
    has_direction = "direction" in records.columns
    latest = F.max_by("direction", F.when(F.col("direction").isNotNull(), F.struct(TS, "direction")))
    per_road = window.groupBy("road_id").agg(
        F.sum("total_vehicles").alias("total_vehicles"),
        (latest if has_direction else F.lit(None).cast("string")).alias("direction"),
    )
    top = per_road.orderBy(F.desc("total_vehicles"), "road_id").limit(1).agg(
        *[F.max(c).alias(c) for c in ("road_id", "total_vehicles", "direction")]
    )
    ids = known.select(F.col("road_id").alias("known_id"))
    first_known = ids.agg(F.min("known_id").alias("m")).scalar()
    return top.join(ids, F.col("road_id") == F.col("known_id"), "left").select(
        F.coalesce("known_id", first_known, "road_id").alias("road_id"),
        F.col("road_id").alias("observed_road_id"), "total_vehicles", "direction",
    )


def latest_per_road(records: DataFrame, by: Sequence[str] = ("region_name", "local_authority_name")) -> DataFrame:
    """The newest row of every road; rows without an id form one group, nameless rows go.

    The newest time per road is a hash aggregate of one narrow column; only the rows of that
    time are compared as a whole. Of those the most vehicles win, then the columns in order.
    """
    rows = records.where(F.col("role") == "road")
    keys = [*by, "road_id"]
    newest = rows.groupBy(*keys).agg(F.max(TS).alias("_newest")).select(*[F.col(k).alias(f"_{k}") for k in keys], "_newest")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    last = rows.join(newest, same & F.col(TS).eqNullSafe(F.col("_newest")), "left_semi")
    rest = [c for c in rows.columns if c not in (*keys, "total_vehicles")]
    picked = last.groupBy(*keys).agg(F.max(F.struct("total_vehicles", *rest)).alias("r"))
    return picked.select(*keys, "r.*").where(F.col("road_name").isNotNull())


def road_edges(latest: DataFrame, by: Sequence[str] = ("region_name", "local_authority_name")) -> DataFrame:
    """Undirected road graph: one edge per junction pair; the newest road of a pair wins."""
    named = lambda c, suffix: F.coalesce(
        F.nullif(c, F.lit("")), F.concat("road_name", F.lit(suffix))
    )
    end = named("end_junction_name", " (fin)")
    length = F.coalesce(
        F.nullif("link_length_kilometers", F.lit(0.0)), F.col("total_link_length_km"), F.lit(0.0)
    )
    edges = latest.withColumn("_s", named("start_junction_name", " (inicio)")).withColumns({
        "_e": F.when(F.col("_s") == end, F.concat(end, F.lit(" (fin)"))).otherwise(end),
        "_len": F.when(length > 0, length).otherwise(F.lit(0.1)),
    })
    return edges.groupBy(
        *by, F.least("_s", "_e").alias("src"), F.greatest("_s", "_e").alias("dst")
    ).agg(
        F.max_by(F.struct("road_id", F.col("_len").alias("length_km")), F.struct(TS, "road_id")).alias("r")
    ).select(
        *by, "src", "dst", "r.road_id", "r.length_km",
        (1 / F.greatest("r.length_km", F.lit(0.1))).alias("weight"),
    )


def road_nodes(edges: DataFrame, by: Sequence[str] = ("region_name", "local_authority_name")) -> DataFrame:
    return edges.select(*by, F.explode(F.array("src", "dst")).alias("junction")).distinct()


def load_ratio(latest: DataFrame, by: Sequence[str] = ("region_name", "local_authority_name")) -> DataFrame:
    """Each road's load between the lowest (0) and highest (1) of its group; 0.5 if all agree."""
    total = F.coalesce(F.col("total_vehicles").cast("double"), F.lit(0.0))
    rows = latest.select(*by, "road_id", "road_name", total.alias("total"))
    bounds = rows.groupBy(*by).agg(F.min("total").alias("lo"), F.max("total").alias("hi"))
    span = F.col("hi") - F.col("lo")
    ratio = F.when(span > 0, (F.col("total") - F.col("lo")) / span).otherwise(F.lit(0.5))
    return rows.join(bounds, list(by)).select(
        *by, "road_id", "road_name", F.col("total").alias("total_vehicles"),
        ratio.alias("ratio"), (2 + 4 * ratio).alias("width"),
    )


def batch_increment(records: DataFrame, batch: str = "batch_id", *, keep: int | None = None) -> DataFrame:
    """New vehicles per batch and per region in it, newest first, for batches with any; only the
    newest ``keep`` if given."""
    per_region = records.where(F.col("role") != "authority").groupBy(batch, "region_name").agg(
        F.sum("total_vehicles").alias("v")
    )
    per_batch = per_region.groupBy(batch).agg(
        F.sum("v").alias("vehicles_new"), F.count("region_name").alias("_regions")
    )
    ordered = per_batch.where(F.col("vehicles_new") > 0).orderBy(F.desc(batch))
    return (ordered if keep is None else ordered.limit(keep)).select(
        batch, "vehicles_new",
        F.when(F.col("_regions") > 0, F.col("vehicles_new") / F.col("_regions")).alias("vehicles_avg_region"),
    )


def recent_records(records: DataFrame, limit: int | None = None) -> DataFrame:
    """Records newest first; only the first ``limit`` if given."""
    shown = [c for c in RECENT_COLUMNS if c in records.columns]
    ties = [c for c in ("role", "region_name", "local_authority_name", "road_id") if c in records.columns]
    ordered = records.orderBy(F.desc(TS), *ties)
    return (ordered if limit is None else ordered.limit(limit)).select(*shown)


def history_append_prune(history: DataFrame, new: DataFrame, *, minutes: int = HISTORY_MINUTES) -> DataFrame:
    return trailing_window(history.unionByName(new, allowMissingColumns=True), minutes)


def road_ids(roads: DataFrame) -> DataFrame:
    return roads.select("road_id").distinct().orderBy("road_id")


def road_count(roads: DataFrame) -> DataFrame:
    return roads.agg(F.count_distinct("road_id").alias("road_count"))


def chart_union(observed: DataFrame, predicted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Observed and predicted values as one long table without gaps."""
    parts = (("observed", observed, "minute"), ("predicted", predicted, "target_ts"))
    a, b = [
        df.select(*by, F.col(ts).alias("ts"), F.lit(label).alias("series"), F.col("value").cast("double").alias("value"))
        for label, df, ts in parts
    ]
    return a.unionByName(b).dropna(subset=["ts", "value"])
