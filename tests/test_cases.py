"""Hand-written cases for the rules that data alone seldom reaches."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import display, parsing
from roadpulse.functions.text import slugify
from roadpulse.operators import analytics, cleaning, gold, profiles, records, scoring
from roadpulse.operators.events import dead_letters, normalise_events, parse_events
from roadpulse.schemas import RAW_EVENT
from tests.conftest import rows

T0 = datetime(2024, 1, 1, 10, 0, tzinfo=timezone.utc)
INGEST = datetime(2024, 1, 2, tzinfo=timezone.utc)


def raw(spark, *payloads):
    data = [("t", 0, i, INGEST, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return spark.createDataFrame(data, RAW_EVENT)


def parsed(spark, *payloads):
    return rows(parse_events(raw(spark, *payloads)), "arrival")


def test_counts_are_read_leniently(spark):
    values = [7, "7", " 12 ", "3.5", 3.7, None, "many", True, -4]
    got = parsed(spark, *[{"all_motor_vehicle_count": v} for v in values])
    assert [r["total_vehicles"] for r in got] == [7, 7, 12, 0, 3, 0, 0, 1, -4]
    # The statistics read fractions and fall back to the classes.
    assert [r["vehicle_count"] for r in got] == [7, 7, 12, 3.5, 3.7, 0, 0, 1, 0]


def test_one_bad_field_does_not_lose_the_record(spark):
    got = parsed(spark, {"all_motor_vehicle_count": {"a": 1}, "car_and_taxi_count": 4, "region_name": "R"})[0]
    assert (got["total_vehicles"], got["cars_and_taxis"], got["vehicle_count"], got["region_name"]) == (0, 4, 4.0, "R")


def test_payloads_that_are_no_objects_are_dead_letters(spark):
    df = raw(spark, {"road_id": "a"}, "[1]", "{broken", "7", "null", "")
    assert len(rows(parse_events(df))) == 1
    assert sorted(r["value"] for r in rows(dead_letters(df))) == sorted(["[1]", "{broken", "7", "null", ""])


@pytest.mark.parametrize("text,want", [
    ("2024-01-01T10:11:12Z", datetime(2024, 1, 1, 10, 11, 12)),
    ("2024-01-01T10:11:12+01:00", datetime(2024, 1, 1, 9, 11, 12)),
    ("2024-01-01 10:11:12+0000", datetime(2024, 1, 1, 10, 11, 12)),
    ("2024-01-01T10:11:12", datetime(2024, 1, 1, 10, 11, 12)),
    ("20240101T101112", datetime(2024, 1, 1, 10, 11, 12)),
    ("2024-01-01", datetime(2024, 1, 1)),
    ("10:11:12", None), ("2024", None), ("soon", None), ("", None),
])
def test_timestamps(spark, text, want):
    got = spark.createDataFrame([(text,)], "x string").select(parsing.parse_ts(F.col("x")).alias("t"))
    # As text: the driver's own time zone has no say.
    shown = got.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("t")).first()["t"]
    assert shown == (want.strftime("%Y-%m-%d %H:%M:%S") if want else None)


def test_time_falls_back_to_other_fields_then_ingest(spark):
    got = parsed(
        spark, {"event_timestamp": "", "timestamp": "2024-01-01T10:00:30Z"}, {"observation_time": "2024-01-01"},
        {"event_timestamp": "bad", "timestamp": "2024-01-01T10:00:30Z"}, {},
    )
    day = lambda r: r["minute"].strftime("%m-%d %H:%M")
    assert [day(r) for r in got] == ["01-01 10:00", "01-01 00:00", "01-02 00:00", "01-02 00:00"]


def test_names_junctions_and_keys(spark):
    got = parsed(
        spark,
        {"road_name": " M1 ", "start_junction_road_name": " X ", "end_junction": "X"},
        {"road_name": "  ", "region_name": "", "road_id": " r9 "},
        {"start_junction_road_name": "  ", "start_junction_name": "Y"},
    )
    assert (got[0]["road_name"], got[0]["start_junction"], got[0]["end_junction"]) == ("M1", "X", "X (fin)")
    assert got[0]["road_key"] == "M1:X->X (fin)"
    assert (got[1]["region_name"], got[1]["road_name"], got[1]["road_key"]) == ("Unknown", "", "r9")
    # A blank first candidate is text, so it wins and then counts as missing.
    assert got[2]["start_junction"] == "Unknown road (inicio)"


def test_lengths_and_heavy_counts(spark):
    got = parsed(
        spark, {"link_length_kilometers": 0, "link_length_miles": 2}, {"link_length_kilometers": -1, "link_length_miles": -3},
        {"link_length_kilometers": "1.5"}, {"all_heavy_goods_vehicle_count": None, "heavy_goods_vehicle_2_rigid_axles_count": 5},
        {"all_heavy_goods_vehicle_count": "x"}, {"all_heavy_goods_vehicle_count": 0},
    )
    assert [round(r["link_length_km"], 5) for r in got[:3]] == [3.21868, 0.0, 1.5]
    assert [r["heavy_vehicles"] for r in got[3:]] == [0, 0, 0]
    six = parse_events(raw(spark, {"heavy_goods_vehicle_2_rigid_axles_count": 5}), heavy_fallback="sum6")
    assert six.first()["heavy_vehicles"] == 5


def test_a_road_across_authorities_has_one_length_in_its_region(spark):
    def one(authority, km):
        return {"event_timestamp": T0.isoformat(), "region_name": "R", "local_authority_name": authority, "road_id": "a",
                "link_length_kilometers": km, "all_motor_vehicle_count": 6}

    all_rows = rows(gold.gold_all(parse_events(raw(spark, one("x", 2), one("y", 3), one("y", 1)))), "role", "local_authority_name")
    assert {(r["role"], r["local_authority_name"]): r["total_link_length_km"] for r in all_rows} == {
        ("authority", "x"): 2, ("authority", "y"): 3, ("primary", None): 3, ("road", "x"): 2, ("road", "y"): 3,
    }


def test_descriptors_take_the_first_known_value(spark):
    base = {"event_timestamp": T0.isoformat(), "road_id": "a", "region_name": "R"}
    events = parse_events(raw(
        spark, base | {"start_junction": "Unknown start"}, base | {"road_name": "B", "start_junction": "S", "road_type": "Major"},
        base | {"road_name": "C", "start_junction": "T"},
    ))
    got = gold.gold_road(events).first()
    assert (got["road_name"], got["start_junction_name"], got["road_type"]) == ("B", "S", "Unknown")


def test_levels_agree(spark, sf):
    from roadpulse.plans import inputs

    sums = inputs.gold_rows(spark, sf).groupBy("role").agg(F.sum("total_vehicles").alias("t"), F.sum("event_count").alias("n"))
    assert len({(r["t"], r["n"]) for r in rows(sums)}) == 1


def test_a_zero_length_region_has_no_density(spark):
    got = gold.gold_region(parse_events(raw(spark, {"all_motor_vehicle_count": 5}))).first()
    assert (got["total_link_length_km"], got["vehicles_per_km"]) == (0.0, 0.0)


def test_typed_events_may_lack_columns(spark):
    df = spark.createDataFrame([("a", 3)], "road_id string, all_motor_vehicle_count int")
    got = normalise_events(df).first()
    assert (got["road_key"], got["total_vehicles"], got["minute"]) == ("a", 3, None)


@pytest.mark.parametrize("text,ascii_,any_", [
    ("North  East!", "north-east", "north-east"), ("Ñandú", "and", "ñandú"), ("--", "unknown", "unknown"), ("", "unknown", "unknown"),
])
def test_slugs(spark, text, ascii_, any_):
    df = spark.createDataFrame([(text,)], "x string")
    got = df.select(slugify(F.col("x")).alias("a"), slugify(F.col("x"), unicode=True).alias("u")).first()
    assert (got["a"], got["u"]) == (ascii_, any_)


def test_display_texts(spark):
    df = spark.range(1)
    lit = F.lit
    got = df.select(
        display.humanize_seconds(lit(93784.9)).alias("a"), display.humanize_seconds(lit(-1.0)).alias("b"),
        display.humanize_seconds(lit(0.5)).alias("c"), display.format_lag(lit(93784.0)).alias("d"),
        display.format_bytes(lit(1280)).alias("e"), display.format_size(lit(-1)).alias("f"),
        display.format_usage(lit(512), lit(2048), lit(None)).alias("g"), display.format_lag(lit(None)).alias("h"),
        display.format_bytes(lit(1024.0**6)).alias("i"),
    ).first()
    assert tuple(got) == ("1d 2h 3m 4s", None, "<1s", "26h 3m 4s", "1.2KB", "N/D", "512.0 B / 2.0 KB (25.0%)", "N/D", "1024.0PB")


def test_density_backfill_is_all_or_nothing(spark):
    schema = "region_name string, total_vehicles int, total_link_length_km double, vehicles_per_km double"
    none = spark.createDataFrame([("a", 6, 2.0, 0.0), ("b", 5, 0.0, None)], schema)
    some = spark.createDataFrame([("a", 6, 2.0, 0.0), ("b", 5, 0.0, 9.0)], schema)
    density = lambda df: [r["vehicles_per_km"] for r in rows(records.normalise_gold(df), "region_name")]
    assert density(none) == [3.0, 0.0]
    assert density(some) == [0.0, 9.0]


def record(region="R", total=1, ts=T0, role="road", **extra):
    return {"role": role, "region_name": region, "local_authority_name": "x", "road_id": "a", "road_name": "A",
            "event_timestamp": ts, "total_vehicles": total, "start_junction_name": None, "end_junction_name": None,
            "link_length_kilometers": 0.0, "total_link_length_km": 0.0, "vehicles_per_km": 0.0, **extra}


RECORD = """role string, region_name string, local_authority_name string, road_id string, road_name string,
event_timestamp timestamp, total_vehicles bigint, start_junction_name string, end_junction_name string,
link_length_kilometers double, total_link_length_km double, vehicles_per_km double"""


def frame(spark, *recs):
    return spark.createDataFrame([tuple(r.values()) for r in recs], RECORD)


def test_equal_loads_get_the_middle(spark):
    df = frame(spark, record(total=4), record(total=4, road_id="b"), record(region="S", total=1), record(region="S", total=3, road_id="b"))
    got = rows(analytics.load_ratio(analytics.latest_per_road(df)), "region_name", "road_id")
    assert [(r["ratio"], r["width"]) for r in got] == [(0.5, 4.0), (0.5, 4.0), (0.0, 2.0), (1.0, 6.0)]


def test_edges_default_and_replace(spark):
    later = T0.replace(minute=5)
    df = frame(
        spark, record(), record(road_id="b", start_junction_name="P", end_junction_name="Q", link_length_kilometers=2.0),
        record(road_id="c", start_junction_name="Q", end_junction_name="P", link_length_kilometers=4.0, ts=later),
        record(road_id="d", start_junction_name="Z", end_junction_name="Z"), record(road_id="e", road_name=None),
    )
    edges = rows(analytics.road_edges(analytics.latest_per_road(df)), "src")
    assert [(e["src"], e["dst"], e["road_id"], e["length_km"]) for e in edges] == [
        ("A (fin)", "A (inicio)", "a", 0.1), ("P", "Q", "c", 4.0), ("Z", "Z (fin)", "d", 0.1),
    ]


def test_primary_falls_back_to_all_rows(spark):
    df = frame(spark, record(), record(role="authority"))
    assert analytics.by_role(df, "primary").count() == 2
    assert analytics.by_role(df.unionByName(frame(spark, record(role="primary"))), "primary").count() == 1


def test_minute_gaps_are_zero_even_over_midnight(spark):
    late, early = datetime(2024, 1, 1, 23, 58, tzinfo=timezone.utc), datetime(2024, 1, 2, 0, 1, 30, tzinfo=timezone.utc)
    df = frame(spark, record(ts=late, total=3), record(ts=early, total=4))
    series = analytics.minute_series(df).orderBy("minute")
    assert [r["value"] for r in series.collect()] == [3, 0, 0, 4]
    assert [r["value"] for r in analytics.minute_series(df, minutes=2).orderBy("minute").collect()] == [0, 4]


def test_predictions_follow_the_rules(spark):
    roads = spark.createDataFrame(
        [("road:a", "A", 4.0), ("road:b", "B", 0.0), ("road:b2", "b ", 9.0)],
        "road_id string, road_name string, baseline_rate_per_minute double",
    )
    hours = spark.createDataFrame([("road:a", 8, 10.0, 2.0), ("road:a", 9, 0.0, 1.0)],
                                  "road_id string, hour int, mean_per_minute double, std_per_minute double")
    mix = spark.createDataFrame([("road:a", "North", 0.75), ("road:a", "South", 0.25)], "road_id string, key string, weight double")
    requests = spark.createDataFrame([
        (1, "road:a", None, 8, None, 1.0), (2, "road:a", None, 9, None, 0.0), (3, "road:a", None, 8, "NORTH", 2.0),
        (4, None, " B", 8, None, 1.0), (5, "road:zzz", None, 8, None, 1.0), (6, "road:zzz", "a", None, "East", 1.0),
        (7, "road:a", None, 24, None, 1.0),
    ], "n int, road_id string, road_name string, hour_of_day int, direction string, scaling_factor double")
    got = rows(scoring.predict(requests, roads, hours, mix, now_hour=F.lit(8)), "n")
    brief = [(r["status"], r["expected_flow_per_minute"], r["lower_bound_per_minute"], r["upper_bound_per_minute"], r["direction_applied"]) for r in got]
    assert brief == [
        ("ok", 10, 6, 14, None),
        ("ok", 4, 2, 6, None),  # a zero mean falls back to the baseline, a zero factor is ignored
        ("ok", 30, 18, 42, "North"),
        ("ok", 9, 9, 9, None),  # of two roads with one name the last wins
        ("not_found", None, None, None, None),
        ("ok", 10, 6, 14, None),
        ("bad_hour", None, None, None, None),
    ]
    assert [r["confidence_level"] for r in got[:4]] == ["medium", "medium", "medium", "low"]
    assert got[5]["road_id"] == "road:zzz" and got[5]["hour_of_day"] == 8


def test_forecast_blends_into_the_expected_flow(spark):
    series = spark.createDataFrame([(T0.replace(minute=m), float(v)) for m, v in enumerate((1, 2, 4, 6, 8, 10))], "minute timestamp, value double")
    flow = spark.createDataFrame([(20.0,)], "expected_flow_per_minute double")
    got = [r["value"] for r in scoring.forecast(series, flow).orderBy("target_ts").collect()]
    # Last 10, trend 2 a minute over the last five values.
    assert got == pytest.approx([0.8 * 12 + 4, 0.6 * 14 + 8, 0.4 * 16 + 12, 0.2 * 18 + 16, 20.0])
    assert scoring.scaling_factor(series).first()["scaling_factor"] == pytest.approx(10 / (31 / 6))


def clean(spark, *recs):
    cols = ["count_point_identifier", "road_name", "all_motor_vehicle_count", "hour_of_day", "observation_date",
            "region_name", "local_authority_name", "travel_direction", "record_ord"]
    schema = "a string, b string, c string, d string, e date, f string, g string, h string, i bigint"
    return spark.createDataFrame([r + (n,) for n, r in enumerate(recs)], schema).toDF(*cols)


def test_prepared_counts_drop_and_default(spark):
    day = date(2024, 1, 1)
    got = rows(cleaning.prepare_counts(clean(
        spark, ("1", " A ", "x", "8", day, None, "", None), ("1", "A", None, "8", day, "R", "L", "N"), ("1", " ", "1", "8", day, "R", "L", "N"),
        ("1", "A", "1", "late", day, "R", "L", "N"), ("1", "A", "1", "8", None, "R", "L", "N"), ("1", "A", "2", "8", day, " R ", "L", ""),
    )), "record_ord")
    brief = [(r["road_name"], r["all_motor_vehicle_count"], r["region_filled"], r["authority_filled"], r["direction_filled"]) for r in got]
    assert brief == [("A", 0.0, "Unknown Region", "Unknown Authority", "Unknown"), ("A", 2.0, "R", "L", "")]


def test_raw_text_is_read_leniently(spark):
    df = spark.createDataFrame(
        [("  7 ", "2001-02-03 00:00:00", " 3 ", " x", "NaN", "1e2"), ("7.0", "soon", "C", "None", "  A1 ", "")],
        "`HOUR` string, `Date` string, direction_of_travel string, region_name string, ` Road_Name ` string, lgvs string",
    )
    got = rows(cleaning.clean_counts(df))
    brief = [(r["hour_of_day"], r["observation_date"], r["travel_direction"], r["region_name"], r["road_name"], r["light_goods_vehicle_count"]) for r in got]
    assert brief == [(7, date(2001, 2, 3), "Eastbound", "x", None, 100.0), (7, None, "C", None, "A1", None)]
    assert got[0]["all_motor_vehicle_count"] is None and got[0]["count_point_identifier"] is None


def test_missing_columns_are_named(spark):
    with pytest.raises(cleaning.MissingColumns, match="observation_date"):
        cleaning.prepare_counts(spark.createDataFrame([("a", 1, 2)], "road_name string, all_motor_vehicle_count int, hour_of_day int"))


def test_a_region_without_matches_shares_by_baseline(spark):
    counts = cleaning.prepare_counts(clean(
        spark, ("1", "A", "5", "8", date(2024, 1, 1), "R", "L", "N"), ("1", "B", "5", "8", date(2024, 1, 1), "R", "L", "N")
    ))
    roads = spark.createDataFrame([("road:a", "A", "R", 1.0), ("road:x", "X", "S", 1.0), ("road:y", "Y", "S", 3.0)],
                                  "road_id string, road_name string, region_name string, baseline_rate_per_minute double")
    got = {(r["region_name"], r["road_id"]): r["weight"] for r in rows(profiles.region_road_share(counts, roads))}
    assert got == {("R", "road:a"): 0.5, ("S", "road:x"): 0.25, ("S", "road:y"): 0.75}


def test_regions_with_one_slug_get_numbers(spark):
    df = spark.createDataFrame([("region:a-b", "A B"), ("region:a-b", "A-B"), ("region:c", "C")], "region_id string, region_name string")
    assert [r["region_slug"] for r in rows(profiles.region_slugs(df), "region_slug")] == ["a-b", "a-b-1", "c"]


def test_status_rows_of_sections_come_first(spark):
    from roadpulse.operators.operations import resource_rows

    row = "struct<component:string,status:string>"
    payload = spark.createDataFrame(
        [([[[("a", "ok"), ("b", "late")]], [None]], [("c", "ok")]), (None, None)],
        f"sections array<struct<rows:array<{row}>>>, rows array<{row}>",
    )
    got = [(r["ord"], r["component"], r["status"]) for r in resource_rows(payload).orderBy("ord").collect()]
    assert got == [(0, "a", "ok"), (1, "b", "late"), (2, "c", "ok")]


def test_merged_lengths_come_from_road_rows(spark):
    """Two batches of one minute: a road that crosses authorities has one length at region level, its
    longest; authority and region rows without road rows keep none, and descriptors take the first known."""
    from roadpulse.operators.gold import merge_gold_partials
    from roadpulse.schemas import GOLD, GOLD_ADDITIVE

    at = datetime(2024, 1, 1, 12)

    def row(role, authority, road, length, batch, name=None):
        values = {f.name: None for f in GOLD.fields} | {n: 1 for n in GOLD_ADDITIVE}
        values |= {"role": role, "region_name": "R", "local_authority_name": authority, "road_id": road, "road_name": name,
                   "event_timestamp": at, "link_length_kilometers": length, "batch_id": batch}
        return tuple(values[f.name] for f in GOLD.fields)

    given = [
        row("primary", None, None, None, 0), row("primary", None, None, None, 1), row("authority", "A", None, None, 0),
        row("authority", "B", None, None, 1), row("road", "A", "r1", 2.0, 0, "Unknown road"), row("road", "A", "r1", 3.0, 1, "M1"),
        row("road", "B", "r1", 5.0, 1, "M1"), row("road", "A", "r2", 7.0, 0, ""), row("road", "A", "r3", -1.0, 1, None),
        row("road", "C", "r4", 11.0, 1, "M4"),  # its authority has no row of its own
    ]
    got = rows(merge_gold_partials(spark.createDataFrame(given, GOLD)), "role", "local_authority_name", "road_id")
    seen = [(r["role"], r["local_authority_name"], r["road_id"], r["event_count"], r["total_link_length_km"], r["road_name"]) for r in got]
    assert seen == [
        ("authority", "A", None, 1, 10.0, None), ("authority", "B", None, 1, 5.0, None),
        ("primary", None, None, 2, 23.0, None),
        ("road", "A", "r1", 2, 3.0, "M1"), ("road", "A", "r2", 1, 7.0, ""), ("road", "A", "r3", 1, 0.0, None),
        ("road", "B", "r1", 1, 5.0, "M1"), ("road", "C", "r4", 1, 11.0, "M4"),
    ]
