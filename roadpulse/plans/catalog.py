"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators import analytics as A
from roadpulse.operators import cleaning as C
from roadpulse.operators import events as E
from roadpulse.operators import gold as G
from roadpulse.operators import operations as O
from roadpulse.operators import profiles as P
from roadpulse.operators import records as R
from roadpulse.operators import runtime as U
from roadpulse.operators import scoring as S
from roadpulse.functions import display
from roadpulse.plans import inputs as I
from roadpulse.sources import driver_tables as src
from roadpulse.session import staged
from roadpulse.sources.tables import failover_union, first_available, prefer_root

Query = Callable[[SparkSession, str], DataFrame]
# 2024-01-01 12:05 UTC, the reading time of the run log.
NOW = 1704110700
PLACE = ("region_name", "local_authority_name")


def _reported(df: DataFrame) -> DataFrame:
    """Six decimals on every floating column, so results compare across engines."""
    return df.select(*[
        F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _no_batch(df: DataFrame) -> DataFrame:
    return df.drop("batch_id", "writer_failover_active")


def _dated(df: DataFrame) -> DataFrame:
    """Dates as text, as the clean table's CSV has them."""
    return df.withColumn("observation_date", F.date_format("observation_date", "yyyy-MM-dd"))


def _foreign_gold(s, sf):
    """Gold rows as another writer names them, without a density."""
    return I.gold_rows(s, sf).select(
        "role", "region_name", "local_authority_name", "road_id",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("timestamp"),
        F.col("total_vehicles").cast("string").alias("all_motor_vehicles"),
        F.col("heavy_vehicles").alias("all_hgvs"),
        "total_link_length_km",
        F.col("pedal_cycles").alias("pedal_cycle_total"), "cars_and_taxis",
    )


def _labelled_subsets(s, sf):
    parts = A.split_by_role(I.live(s, sf))
    out = None
    for name, df in parts.items():
        one = df.select(
            F.lit(name).alias("subset"), "role", *PLACE, "road_id", "event_timestamp", "total_vehicles"
        )
        out = one if out is None else out.unionByName(one)
    return out


def _directed(s, sf):
    """Live records with the direction column some writers add."""
    minute = F.minute("event_timestamp")
    return I.live(s, sf).withColumn(
        "direction", F.when(minute % 5 != 0, F.concat(F.lit("D"), minute % 4))
    )


def _windowed(s, sf):
    return A.trailing_window(I.live(s, sf), I.WINDOW)


def _window_primary(s, sf):
    return A.by_role(_windowed(s, sf), "primary")


def _latest(s, sf):
    return A.latest_per_road(I.live(s, sf))


def _history(s, sf):
    """Old rows and new ones, split by hour of day."""
    rows = I.live(s, sf).select("role", *PLACE, "road_id", "event_timestamp", "total_vehicles")
    early = F.hour("event_timestamp") < 11
    return A.history_append_prune(rows.where(early), rows.where(~early), minutes=I.WINDOW)


def _clean(s, sf):
    return _dated(C.clean_counts(src.raw_counts(s, sf)))


def _prepared(s, sf):
    p = C.prepare_counts(C.clean_counts(src.raw_counts(s, sf)))
    return _dated(p).select(
        "record_ord", "road_name", "all_motor_vehicle_count", "hour", "observation_date",
        "region_filled", "authority_filled", "direction_filled",
    )


def _regions(s, sf):
    return P.region_profile(I.counts(s, sf), I.roads(s, sf))


def _completed(s, sf):
    """Hours of the running profiles, where a high bar leaves some roads without any."""
    hours = U.runtime_hours(I.run_stats(s, sf), min_observations=20)
    return P.complete_hour_profile(
        # Odd hours lose their deviation, so its default shows.
        hours.withColumn("std_per_minute", F.when(F.col("hour") % 2 == 0, F.col("std_per_minute"))),
        I.run_roads(s, sf).select("road_id", "baseline_rate_per_minute"),
    )


def _expected_rate(s, sf):
    counts = I.counts(s, sf)
    # The profile tables are read several times below, as their stored form would be.
    roads = staged(P.assigned_region(I.roads(s, sf)))
    regions = staged(P.validated_region(P.region_profile(counts, roads)))
    road_hours = P.complete_hour_profile(P.by_road_id(roads, P.road_hour_profile(counts)), roads)
    region_hours = P.complete_hour_profile(P.region_hour_profile(counts), regions, "region_name")
    share = P.region_road_share(counts, roads)
    return S.expected_road_rate(roads, staged(road_hours), share, regions, region_hours)


def _predict(s, sf):
    counts, roads = I.counts(s, sf), staged(I.roads(s, sf))
    return S.predict(
        I.requests(s, sf), roads,
        P.by_road_id(roads, P.road_hour_profile(counts)),
        staged(P.by_road_id(roads, P.road_direction_mix(counts))),
    ).drop("model", "notes")


def _kept(s, sf):
    p = I.predictions(s, sf)
    return S.kept_predictions(
        p, ["region_name"], as_of=I.last_generation(p), keep=2, history_minutes=I.WINDOW
    )


def _history_of_predictions(s, sf):
    p = I.predictions(s, sf)
    return S.prediction_history(
        p, ["region_name"], as_of=I.last_generation(p), keep=2, history_minutes=I.WINDOW
    )


def _forecast(s, sf):
    return S.forecast(I.region_series(s, sf), I.region_flow(s, sf), ["region_name"])


def _first_available(s, sf):
    """Two choices: a first source that has rows, and one that has none (no road is observed that often)."""
    cols = ["road_id", "road_name", "baseline_rate_per_minute"]
    usual = I.roads(s, sf).select(*cols)
    strict = P.road_profile(I.counts(s, sf), min_observations=10**12).select(*cols)
    named = lambda choice, df: df.withColumn("choice", F.lit(choice))
    return named("second", first_available([strict, usual])).unionByName(named("first", first_available([usual, strict])))


def _preferred_root(s, sf):
    """Two writers of the gold table; the first stopped at six, the second wrote everything."""
    rows = I.gold_rows(s, sf).select("role", *PLACE, "road_id", "event_timestamp", "total_vehicles")
    keys = ["role", *PLACE, "road_id", "event_timestamp"]
    return prefer_root([rows.where(F.hour("event_timestamp") < 6), rows], keys)


def _failed_over(s, sf):
    """Gold partials of two roots: every third batch failed over; one batch is in both, as after a retry."""
    rows = I.gold_partials(s, sf).select("role", *PLACE, "road_id", "event_timestamp", "batch_id", "total_vehicles")
    third = F.col("batch_id") % 3
    return failover_union([rows.where(third != 1), rows.where((third == 1) | (F.col("batch_id") == 0))])


def _merged_metadata(s, sf):
    """Descriptors over batches, half of which know no road type."""
    known = I.events(s, sf).withColumn(
        "meta_road_type", F.when(F.col("batch_id") % 2 == 1, F.col("meta_road_type")).otherwise(F.lit("")))
    return U.merge_metadata(U.batch_metadata(known, batch=["batch_id"]), "batch_id")


def _validated_mix(s, sf):
    """Direction shares read back; the roads whose name ends in 3 lost theirs."""
    roads = I.roads(s, sf)
    mix = P.by_road_id(roads, P.road_direction_mix(I.counts(s, sf)))
    weight = F.when(F.col("road_id").endswith("3"), F.lit(0.0)).otherwise(F.col("weight") * 2)
    return P.validated_mix(mix.withColumn("weight", weight), roads, "road_id", P.DEFAULT_MIX["direction"])


def _meta(s, sf):
    counts, roads = I.counts(s, sf), staged(I.roads(s, sf))
    return P.profile_meta(roads, P.region_profile(counts, roads), P.segment_catalogue(counts))


def _slices(s, sf):
    roads = staged(I.roads(s, sf))
    return P.region_slices(P.region_profile(I.counts(s, sf), roads), roads)


def _raw_index(s, sf):
    """A region index with the faults of a foreign file."""
    nth = F.length("region_name")
    rate = F.col("baseline_rate_per_minute")
    return P.region_index(_regions(s, sf)).select(
        F.when(nth % 2 == 0, F.col("id")).otherwise(F.lit(" ")).alias("id"),
        F.concat(F.lit(" "), "region_name", F.lit(" ")).alias("region_name"),
        F.when(nth == 4, "n/a").when(nth == 7, (-rate).cast("string")).otherwise(rate.cast("string"))
        .alias("baseline_rate_per_minute"),
        F.when(nth == 6, "x").otherwise(F.col("road_count").cast("string")).alias("road_count"),
    )


def _display_texts(s, sf):
    """The text forms of durations, sizes and usage over the part table."""
    key = F.col("p_partkey")
    seconds = (key * 977 - 500).cast("double") / 4
    size = key * key * 1280
    return src.load(s, sf, "part").select(
        "p_partkey",
        display.humanize_seconds(seconds).alias("humanized"),
        display.format_lag(seconds).alias("lag"),
        display.format_bytes(size).alias("bytes"),
        display.format_size(size - 100000).alias("size"),
        display.format_usage(size, size * 4 - 5120, F.lit(None).cast("double")).alias("usage"),
    )


def _weights(s, sf):
    """Customer balances as raw weights: negative ones drop out."""
    c = src.load(s, sf, "customer")
    w = F.when(F.col("c_custkey") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return S.normalise_weights(c.select("c_mktsegment", "c_custkey", w.alias("weight")), ["c_mktsegment"])


def _class_rows(s, sf):
    return R.unpivot_classes(I.gold_rows(s, sf), ["role", *PLACE, "road_id", "event_timestamp"])


_QUERIES: dict[str, Query] = {
    # events
    "normalise_events": lambda s, sf: E.parse_events(src.raw_events(s, sf)),
    "silver_keys": lambda s, sf: E.silver_keys(I.events(s, sf)).select("event_id", "region_slug", "dt", "hour"),
    "unpivot_classes": _class_rows,
    # gold
    "gold_region": lambda s, sf: G.gold_region(I.events(s, sf)),
    "gold_authority": lambda s, sf: G.gold_authority(I.events(s, sf)),
    "gold_road": lambda s, sf: G.gold_road(I.events(s, sf)),
    "gold_all": I.gold_rows,
    "distinct_link_length": lambda s, sf: G.distinct_link_length(I.events(s, sf)),
    "first_known_descriptor": lambda s, sf: G.first_known_descriptor(I.events(s, sf)),
    "merge_gold_partials": lambda s, sf: G.merge_gold_partials(I.gold_partials(s, sf)),
    "normalise_gold": lambda s, sf: R.normalise_gold(_foreign_gold(s, sf)),
    "vehicle_mix_totals": lambda s, sf: A.vehicle_mix_totals(A.by_role(I.live(s, sf), "primary")),
    # counts
    "clean_counts": _clean,
    "prepare_counts": _prepared,
    # profiles
    "segment_catalogue": lambda s, sf: P.segment_catalogue(I.counts(s, sf)),
    "road_base_stats": lambda s, sf: P.road_base_stats(I.counts(s, sf)),
    "road_direction_mix": lambda s, sf: P.road_direction_mix(I.counts(s, sf)),
    "road_hour_profile": lambda s, sf: P.road_hour_profile(I.counts(s, sf)),
    "road_vehicle_mix": lambda s, sf: P.road_vehicle_mix(I.counts(s, sf)),
    "road_baseline": lambda s, sf: P.road_baseline(P.road_hour_profile(I.counts(s, sf))),
    "road_profile": I.roads,
    "region_hour_profile": lambda s, sf: P.region_hour_profile(I.counts(s, sf)),
    "region_vehicle_mix": lambda s, sf: P.region_vehicle_mix(I.counts(s, sf), I.roads(s, sf)),
    "region_direction_mix": lambda s, sf: P.region_direction_mix(I.counts(s, sf), I.roads(s, sf)),
    "region_authority_mix": lambda s, sf: P.region_authority_mix(I.counts(s, sf), I.roads(s, sf)),
    "region_road_share": lambda s, sf: P.region_road_share(I.counts(s, sf), staged(I.roads(s, sf))),
    "region_profile": _regions,
    "road_index": lambda s, sf: P.road_index(P.profiled_roads(I.counts(s, sf))).orderBy("road_name"),
    "region_index": lambda s, sf: P.region_index(_regions(s, sf)).orderBy("region_name"),
    "profile_meta": _meta,
    "region_slices": _slices,
    "list_regions_clean": lambda s, sf: P.list_regions_clean(_raw_index(s, sf)),
    "first_available": _first_available,
    "prefer_root": _preferred_root,
    "failover_union": _failed_over,
    # running profiles
    "minute_totals": lambda s, sf: U.minute_totals(I.events(s, sf)),
    "welford_single_batch": I.run_stats,
    "welford_merge": lambda s, sf: U.merge_stats(_batch_parts(s, sf)),
    "direction_counts": lambda s, sf: U.direction_counts(I.events(s, sf)),
    "merge_metadata": _merged_metadata,
    "runtime_road_profile": I.run_roads,
    "runtime_hours": lambda s, sf: U.runtime_hours(
        I.run_stats(s, sf), min_observations=I.RUNTIME_MIN_OBSERVATIONS
    ),
    "runtime_direction_mix": lambda s, sf: U.runtime_direction_mix(U.direction_counts(I.events(s, sf))),
    "runtime_region_profile": lambda s, sf: U.runtime_region_profile(I.run_roads(s, sf)),
    # scoring
    "lookup_profile": lambda s, sf: S.lookup_profile(I.requests(s, sf), staged(I.roads(s, sf))),
    "predict": _predict,
    "scaling_factor": lambda s, sf: S.scaling_factor(I.region_series(s, sf), ["region_name"]),
    "forecast_5min": _forecast,
    "prediction_history": _history_of_predictions,
    "worst_prediction": lambda s, sf: S.worst_prediction(I.region_series(s, sf), _kept(s, sf), ["region_name"]),
    "normalise_weights": _weights,
    "complete_hour_profile": _completed,
    "validated_profile": lambda s, sf: P.validated_profile(I.roads(s, sf)),
    "validated_mix": _validated_mix,
    "expected_road_rate": _expected_rate,
    # analytics
    "trailing_window": lambda s, sf: A.trailing_window(I.live(s, sf), A.LIVE_MINUTES).select(
        "role", *PLACE, "road_id", "event_timestamp", "total_vehicles", "vehicles_per_km"
    ),
    "split_by_role": _labelled_subsets,
    "window_kpis": lambda s, sf: A.window_kpis(_window_primary(s, sf)),
    "region_totals": lambda s, sf: A.region_totals(_window_primary(s, sf)),
    "region_density": lambda s, sf: A.region_density(_window_primary(s, sf)),
    "minute_series": lambda s, sf: A.minute_series(I.live(s, sf), minutes=A.HISTORY_MINUTES),
    "density_series": lambda s, sf: A.density_series(_window_primary(s, sf)),
    "vehicle_share": lambda s, sf: A.vehicle_share(_window_primary(s, sf)),
    "region_breakdown": lambda s, sf: A.region_breakdown(_window_primary(s, sf)),
    "authority_breakdown": lambda s, sf: A.authority_breakdown(_windowed(s, sf)),
    "authority_totals": lambda s, sf: A.authority_totals(_windowed(s, sf)),
    "top_roads_by_volume": lambda s, sf: A.top_roads_by_volume(I.live(s, sf)),
    "top_roads_by_density": lambda s, sf: A.top_roads_by_density(I.live(s, sf)),
    "busiest_road": lambda s, sf: A.busiest_road(_directed(s, sf), I.run_roads(s, sf), minutes=I.WINDOW),
    "latest_per_road": lambda s, sf: _latest(s, sf).select(
        *PLACE, "road_id", "road_name", "event_timestamp", "total_vehicles",
        "start_junction_name", "end_junction_name", "link_length_kilometers",
    ),
    "road_edges": lambda s, sf: A.road_edges(_latest(s, sf)),
    "road_nodes": lambda s, sf: A.road_nodes(A.road_edges(_latest(s, sf))),
    "load_ratio": lambda s, sf: A.load_ratio(_latest(s, sf)),
    "batch_increment": lambda s, sf: A.batch_increment(
        R.normalise_gold(I.gold_partials(s, sf), backfill=False)
    ),
    "recent_records": lambda s, sf: A.recent_records(I.live(s, sf)),
    "history_append_prune": _history,
    "road_ids": lambda s, sf: A.road_ids(I.run_roads(s, sf)),
    "road_count": lambda s, sf: A.road_count(I.run_roads(s, sf)),
    "chart_union": lambda s, sf: A.chart_union(I.region_series(s, sf), _forecast(s, sf), ["region_name"]),
    # operations
    "pipeline_freshness": lambda s, sf: O.pipeline_freshness(I.run_log(s, sf), F.lit(NOW)),
    "component_metrics": lambda s, sf: O.component_metrics(I.component_rows(s, sf)),
    "display_texts": _display_texts,
}


def _batch_parts(s, sf):
    """Statistics of each batch on its own, as the stream hands them to the state."""
    e = I.events(s, sf).where(F.col("road_id") != "")
    totals = e.groupBy("batch_id", "road_id", "minute").agg(F.sum("vehicle_count").alias("total"))
    value = F.greatest("total", F.lit(0.0))
    hours = F.array(F.hour("minute"), F.lit(None).cast("int"))
    return totals.withColumn("hour", F.explode(hours)).groupBy("batch_id", "road_id", "hour").agg(
        F.count(F.lit(1)).alias("count"), F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(F.lit(1))).alias("m2"),
    )


_SHAPE: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{n: _no_batch for n in ("gold_region", "gold_authority", "gold_road", "gold_all", "merge_gold_partials")},
}


def _registered(name: str, query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _reported(_SHAPE.get(name, lambda df: df)(query(spark, sf_dir)))

    run.__name__ = name
    return run


def queries() -> dict[str, Query]:
    return {name: _registered(name, q) for name, q in _QUERIES.items()}
