"""Stream jobs on a file source, driven to the end by availableNow triggers."""

from __future__ import annotations

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from tests.conftest import rows, same
from pyspark.sql import functions as F

from roadpulse.operators import gold, runtime
from roadpulse.operators.events import parse_events
from roadpulse.schemas import RAW_EVENT, STORED_GOLD
from roadpulse.sinks import writers
from roadpulse.sources import driver_tables as src
from roadpulse.sources import streams
from roadpulse.sources.tables import table_or_empty
from roadpulse.streaming import maintenance, medallion, merged, state
from roadpulse.streaming.medallion import Layout, process_batch, run_medallion

ADDITIVE = ["total_vehicles", "event_count", "heavy_vehicles"]
T0 = datetime(2024, 1, 1, 10, 0, tzinfo=timezone.utc)


def land(spark, folder, events, part=0, start=0):
    """Write payload dicts (or raw texts) as one landed file."""
    data = [
        ("traffic.raw.x", part, start + i, T0, e if isinstance(e, str) else json.dumps(e))
        for i, e in enumerate(events)
    ]
    spark.createDataFrame(data, RAW_EVENT).coalesce(1).write.mode("append").json(str(folder))


def event(i, minute, road="r1", count=10, **extra):
    ts = (T0 + timedelta(minutes=minute)).isoformat()
    return {"event_id": f"e{i}", "event_timestamp": ts, "region_name": "North East", "local_authority_name": "A",
            "road_id": road, "road_name": road.upper(), "all_motor_vehicle_count": count,
            "link_length_kilometers": 2.0, "travel_direction": "N", **extra}


def run(spark, folder, layout, checkpoint, max_files=1):
    source = streams.landed_events(spark, str(folder), max_files=max_files)
    run_medallion(source, layout, str(checkpoint), available_now=True).awaitTermination()


def test_medallion_equals_batch(spark, sf, tmp_path):
    raw = src.raw_events(spark, sf)
    for i, half in enumerate((raw.where(F.col("offset") < 400), raw.where(F.col("offset") >= 400))):
        half.coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    layout = Layout(str(tmp_path / "out"))
    run(spark, tmp_path / "in", layout, tmp_path / "ck")

    events = parse_events(raw)
    silver = spark.read.parquet(layout.path("silver"))
    dead = spark.read.parquet(layout.path("dead_letters"))
    assert silver.count() == events.count()
    assert silver.count() + dead.count() == raw.count()
    assert {"region_slug", "dt", "hour", "batch_id"} <= set(silver.columns)

    # Two batches, merged on read, give the roll-up of all events.
    partial = spark.read.parquet(layout.path("gold"))
    assert partial.select("batch_id").distinct().count() == 2
    compact = gold.merge_gold_partials(partial)
    whole = gold.gold_all(parse_events(spark.read.schema(RAW_EVENT).json(str(tmp_path / "in"))))
    cols = ["role", "region_name", "local_authority_name", "road_id", "road_name", "start_junction_name", "event_timestamp",
            *ADDITIVE, F.round("total_link_length_km", 6).alias("len"), F.round("vehicles_per_km", 6).alias("d")]
    same(compact.select(*cols), whole.select(*cols))

    log = rows(spark.read.parquet(layout.path("run_log")), "batch_id")
    assert sum(r["total_events"] for r in log) == events.count()
    assert sum(r["gold_records"] for r in log) == partial.count()
    assert not any(r["writer_failover_active"] for r in log)


def test_restart_and_replay_do_not_duplicate(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    land(spark, tmp_path / "in", [event(1, 0), event(2, 0)])
    run(spark, tmp_path / "in", layout, tmp_path / "ck")
    land(spark, tmp_path / "in", [event(3, 0, count=5)], start=2)
    run(spark, tmp_path / "in", layout, tmp_path / "ck")
    # The last batch once more, as after a crash between the writes and the commit.
    again = spark.createDataFrame([("traffic.raw.x", 0, 2, T0, json.dumps(event(3, 0, count=5)))], RAW_EVENT)
    process_batch(again, 1, layout)

    assert spark.read.parquet(layout.path("silver")).count() == 3
    total = spark.read.parquet(layout.path("gold")).where("role = 'primary'").agg(F.sum("total_vehicles")).first()[0]
    assert total == 25
    overall = rows(state.read_state(spark, layout.path("state"), "stats").where("hour is null"))
    # One minute over two batches is two observations: 20 and 5.
    assert [(r["count"], r["mean"], r["m2"]) for r in overall] == [(2, 12.5, 112.5)]
    assert rows(state.read_state(spark, layout.path("state"), "directions"))[0]["count"] == 25


def test_state_compaction_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "state")
    for i, counts in enumerate(([4, 9], [7], [1, 2, 3])):
        raw = spark.createDataFrame(
            [("t", 0, 10 * i + n, T0, json.dumps(event(n, n, count=c))) for n, c in enumerate(counts)], RAW_EVENT
        )
        state.write_delta(state.batch_state(parse_events(raw)), root, i)
    before = rows(state.read_state(spark, root, "stats"), "hour")
    state.compact(spark, root, 1)
    after = rows(state.read_state(spark, root, "stats"), "hour")
    assert len(before) == len(after) == 2
    for a, b in zip(before, after):
        assert a["count"] == b["count"] == 6
        assert a["mean"] == pytest.approx(b["mean"])
        assert a["m2"] == pytest.approx(b["m2"]) == pytest.approx(47.333333, abs=1e-5)
    tables = state.running_profiles(spark, root, min_observations=1)
    road = rows(tables["road_profile"])[0]
    assert (road["road_id"], road["road_name"], road["region_id"]) == ("r1", "R1", "region:north-east")
    assert rows(tables["road_mix"])[0]["weight"] == 1.0


def test_state_is_empty_before_the_first_batch(spark, tmp_path):
    for name in ("stats", "directions", "meta"):
        assert state.read_state(spark, str(tmp_path / "none"), name).isEmpty()


def batch_of(spark, *events, start=0):
    return spark.createDataFrame([("t", 0, start + n, T0, e if isinstance(e, str) else json.dumps(e)) for n, e in enumerate(events)], RAW_EVENT)


def vehicles(frame, role="primary"):
    return gold.merge_gold_partials(frame).where(F.col("role") == role).agg(F.sum("total_vehicles")).first()[0]


@pytest.mark.parametrize("blocked", ["all", "gold", "run_log"])
def test_a_batch_fails_over_as_a_whole(spark, tmp_path, blocked):
    """The root, or one table of it, cannot be written: every table goes to the spare root."""
    root = tmp_path / "root"
    if blocked == "all":
        root.write_text("a file where the root should be")
    else:
        root.mkdir()
        (root / blocked).write_text("a file where the table's folder should be")
    layout = Layout(str(root), failover=str(tmp_path / "spare"))
    process_batch(batch_of(spark, event(1, 0), "not json"), 0, layout)
    spare = spark.read.parquet(str(tmp_path / "spare" / "gold"))
    assert spare.count() == spare.where("writer_failover_active").count() == 3
    assert spark.read.parquet(str(tmp_path / "spare" / "dead_letters")).count() == 1
    # The root is back: what the batch left there before it failed does not count a second time.
    (root if blocked == "all" else root / blocked).unlink()
    log = rows(medallion.run_log(spark, layout))
    assert [(r["batch_id"], r["gold_records"], r["total_events"], r["writer_failover_active"], r["source_root"]) for r in log] == [(0, 3, 1, True, 1)]
    assert vehicles(medallion.read_gold(spark, layout)) == 10
    states = [f"{r}/state" for r in layout.roots]
    assert rows(state.read_state(spark, states, "directions"))[0]["count"] == 10


def test_roots_share_a_minute_and_a_retry_counts_once(spark, tmp_path):
    root, away = tmp_path / "root", tmp_path / "away"
    layout = Layout(str(root), failover=str(tmp_path / "spare"))
    process_batch(batch_of(spark, event(1, 0, count=10)), 1, layout)
    root.rename(away)
    root.write_text("down")
    second = batch_of(spark, event(2, 0, count=7), start=1)
    process_batch(second, 2, layout)  # the same minute, on the other root
    root.unlink()
    away.rename(root)
    assert vehicles(medallion.read_gold(spark, layout)) == 17
    assert medallion.newest_event(spark, layout) is not None
    process_batch(second, 2, layout)  # a retry that reaches the first root
    assert vehicles(medallion.read_gold(spark, layout)) == 17
    assert sorted((r["batch_id"], r["source_root"]) for r in rows(medallion.run_log(spark, layout))) == [(1, 0), (2, 0)]
    counts = state.read_state(spark, [f"{r}/state" for r in layout.roots], "directions")
    assert rows(counts)[0]["count"] == 17


def test_maintenance_changes_no_result(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    for i in range(6):
        process_batch(batch_of(spark, event(2 * i, 20 * i, count=3), event(2 * i + 1, 20 * i, road="r2", count=4), start=2 * i), i, layout)

    def picture():
        merged_rows = gold.merge_gold_partials(medallion.read_gold(spark, layout))
        cols = ["role", "region_name", "local_authority_name", "road_id", "road_name", "event_timestamp", *ADDITIVE, "total_link_length_km"]
        return sorted(map(str, merged_rows.select(*cols).collect())), sorted(
            (r["road_id"], str(r["hour"]), r["count"], round(r["mean"], 9)) for r in rows(state.read_state(spark, layout.path("state"), "stats"))), sorted(
            (r["batch_id"], r["gold_records"]) for r in rows(medallion.run_log(spark, layout)))

    before = picture()
    maintenance.maintain(spark, layout)
    assert picture() == before
    folded = spark.read.parquet(layout.path("gold_folded"))
    assert folded.count() == folded.select("role", "region_name", "local_authority_name", "road_id", "event_timestamp").distinct().count() > 0
    # The partial rows of the folded hour are gone, and so are the folded deltas.
    assert not list((tmp_path / "out" / "gold" / "dt=20240101" / "hour=10").glob("batch_id=*"))
    assert not list((tmp_path / "out" / "state" / "stats" / "delta").glob("batch_id=*"))
    # A late event of a folded hour still counts, before and after the next fold.
    process_batch(batch_of(spark, event(90, 5, count=100), start=90), 6, layout)
    assert vehicles(medallion.read_gold(spark, layout)) == 6 * 7 + 100
    after = picture()
    maintenance.maintain(spark, layout)
    assert picture() == after
    maintenance.maintain(spark, layout)
    assert picture() == after
    window = medallion.read_gold(spark, layout, minutes=15)
    assert gold.merge_gold_partials(window).where("role = 'road'").count() == 2
    # Old days go.
    process_batch(batch_of(spark, event(91, 60 * 24 * 40), start=91), 7, layout)
    maintenance.maintain(spark, layout, keep_days=30)
    assert vehicles(medallion.read_gold(spark, layout)) == 10


def test_an_event_dated_far_ahead_removes_no_day(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"), failover=str(tmp_path / "spare"))
    now = (datetime.now(timezone.utc) - T0) // timedelta(minutes=1)
    process_batch(batch_of(spark, event(1, 0), event(2, now), event(3, now + 60 * 24 * 365 * 50)), 0, layout)
    process_batch(batch_of(spark, event(4, now), start=3), 1, layout)  # the high-water mark goes on

    def ids():
        return sorted(json.loads(r["value"])["event_id"] for r in spark.read.parquet(layout.path("silver")).collect())

    maintenance.maintain(spark, layout)
    assert ids() == ["e1", "e2", "e3", "e4"]
    # With a limit the days before the reading go, and only those.
    maintenance.maintain(spark, layout, keep_days=30)
    assert ids() == ["e2", "e3", "e4"]
    assert vehicles(medallion.read_gold(spark, layout)) == 30


def test_days_stay_unless_a_limit_is_given(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    process_batch(batch_of(spark, event(1, 0), event(2, 60 * 24 * 40)), 0, layout)
    maintenance.maintain(spark, layout)
    assert vehicles(medallion.read_gold(spark, layout)) == 20
    assert spark.read.parquet(layout.path("silver")).count() == 2


def test_failover_without_a_spare_raises():
    def fail(root, flagged):
        raise OSError(root)

    with pytest.raises(OSError):
        writers.write_with_failover(fail, "a")


def test_late_events_are_kept_and_marked(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    land(spark, tmp_path / "in", [event(1, 60)])
    run(spark, tmp_path / "in", layout, tmp_path / "ck")
    land(spark, tmp_path / "in", [event(2, 30), event(3, 55)], start=1)
    run(spark, tmp_path / "in", layout, tmp_path / "ck")
    gold_rows = spark.read.parquet(layout.path("gold")).where("role = 'primary'")
    assert gold_rows.count() == 3
    late = rows(spark.read.parquet(layout.path("gold_late")).where("role = 'primary'"))
    assert [r["event_timestamp"] for r in late] == [datetime(2024, 1, 1, 10, 30)]


@pytest.mark.parametrize("role,keys", [
    ("primary", ["region_name"]), ("authority", ["region_name", "local_authority_name"]),
])
def test_merged_stream_equals_batch(spark, sf, tmp_path, role, keys):
    raw = src.raw_events(spark, sf)
    raw.coalesce(1).write.json(str(tmp_path / "in"))
    # Closes every minute of the events above.
    land(spark, tmp_path / "in", [event("z", 60 * 24 * 30)], start=10**6)
    events = parse_events(streams.landed_events(spark, str(tmp_path / "in"), max_files=1))
    name = f"merged_{role}"
    query = (
        merged.gold_merged(events, role, watermark="2 days").writeStream.outputMode("append").format("memory")
        .queryName(name).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    query.awaitTermination()
    cols = [*keys, "event_timestamp", *ADDITIVE, F.round("total_link_length_km", 6).alias("len")]
    stored = parse_events(spark.read.schema(RAW_EVENT).json(str(tmp_path / "in")))
    whole = (gold.gold_region if role == "primary" else gold.gold_authority)(stored)
    bounded = F.col("event_timestamp") < "2024-01-20"
    same(spark.table(name).where(bounded).select(*cols), whole.where(bounded).select(*cols))


def test_closed_minutes_do_not_depend_on_batches(spark, tmp_path):
    # One minute split over two files, then a far event that closes it.
    land(spark, tmp_path / "in", [event(1, 0, count=4)])
    land(spark, tmp_path / "in", [event(2, 0, count=6), event(3, 1, count=2)], start=1)
    land(spark, tmp_path / "in", [event(9, 600)], start=5)
    events = parse_events(streams.landed_events(spark, str(tmp_path / "in"), max_files=1))
    merged.run_closed_minutes(
        events, str(tmp_path / "state"), str(tmp_path / "ck"), available_now=True
    ).awaitTermination()
    overall = rows(state.read_state(spark, str(tmp_path / "state"), "stats").where("hour is null"))
    assert [(r["count"], r["mean"]) for r in overall] == [(2, 6.0)]


def test_replay_drops_repeated_ids(spark, tmp_path):
    land(spark, tmp_path / "in", [event(1, 0), event(2, 0), "not json"])
    spool = tmp_path / "spool"
    spool.mkdir()
    (spool / "a.json").write_text(json.dumps(event(2, 0)))
    (spool / "b.json").write_text(json.dumps(event(7, 0)))
    both = streams.with_replay(
        streams.landed_events(spark, str(tmp_path / "in")),
        streams.spooled_events(spark, str(spool), str(tmp_path / "archive")),
    )
    query = (
        both.writeStream.format("memory").queryName("replayed").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "ck")).start()
    )
    query.awaitTermination()
    ids = sorted(json.loads(r["value"])["event_id"] for r in spark.table("replayed").collect() if r["value"][0] == "{")
    assert ids == ["e1", "e2", "e7"]
    assert spark.table("replayed").count() == 4


def test_replay_after_an_outage_of_any_length(spark, tmp_path):
    """Live rows are read first, the spooled ones are hours and days older: none is late."""
    spool = tmp_path / "spool"
    spool.mkdir()

    def replay():
        both = streams.with_replay(
            streams.landed_events(spark, str(tmp_path / "in")),
            streams.spooled_events(spark, str(spool), str(tmp_path / "archive")),
        )
        both.writeStream.format("parquet").option("path", str(tmp_path / "read")).trigger(availableNow=True).option(
            "checkpointLocation", str(tmp_path / "ck")).start().awaitTermination()
        return spark.read.schema(RAW_EVENT).parquet(str(tmp_path / "read"))

    now = datetime.now(timezone.utc)
    live = [("traffic.raw.x", 0, n, now, json.dumps(event(n, 0))) for n in range(2)]
    spark.createDataFrame(live[:1], RAW_EVENT).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    assert replay().count() == 1
    for n, age in enumerate((3 * 3600, 3 * 86400, 8 * 86400)):
        for twin in "ab":  # two files of one time
            file = spool / f"{n}{twin}.json"
            file.write_text(json.dumps(event(f"s{n}{twin}", 0)))
            os.utime(file, (now.timestamp() - age,) * 2)
    spark.createDataFrame(live[1:], RAW_EVENT).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    got = replay().cache()
    assert got.count() == 8
    events = parse_events(got).select("event_id", "arrival").orderBy("arrival").collect()
    ids = [r["event_id"] for r in events]
    # Live rows first, then the spooled ones from the oldest file on, each with a number of its own.
    assert [i[:3] for i in ids] == ["e0", "e1", "es2", "es2", "es1", "es1", "es0", "es0"]
    assert len({r["arrival"] for r in events}) == 8


def test_gold_stream_reads_every_file_once_and_old_ones_too(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    process_batch(batch_of(spark, event(1, 0)), 0, layout)
    for file in (tmp_path / "out" / "gold").rglob("*.parquet"):
        os.utime(file, (10**9, 10**9))  # years before the next one
    process_batch(batch_of(spark, event(2, 1), start=1), 1, layout)
    for _ in range(2):
        streams.gold_stream(spark, layout.path("gold"), STORED_GOLD).writeStream.format("parquet").option(
            "path", str(tmp_path / "seen")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    seen = spark.read.parquet(str(tmp_path / "seen"))
    assert seen.count() == spark.read.parquet(layout.path("gold")).count() == 6


def test_merged_gold_is_stored_at_all_levels(spark, sf, tmp_path):
    raw = src.raw_events(spark, sf)
    raw.coalesce(1).write.json(str(tmp_path / "in"))
    land(spark, tmp_path / "in", [event("z", 60 * 24 * 30)], start=10**6)
    events = parse_events(streams.landed_events(spark, str(tmp_path / "in"), max_files=1))
    for query in merged.run_gold_merged(events, str(tmp_path / "merged"), str(tmp_path / "ck"), watermark="2 days", available_now=True):
        query.awaitTermination()
    stored = parse_events(spark.read.schema(RAW_EVENT).json(str(tmp_path / "in")))
    bounded = F.col("event_timestamp") < "2024-01-20"
    for role, whole, keys in (
        ("primary", gold.gold_region(stored), ["region_name"]),
        ("road", gold.gold_road(stored).withColumnRenamed("road_id", "road_key"), ["region_name", "local_authority_name", "road_key"]),
    ):
        cols = [*keys, "event_timestamp", *ADDITIVE, F.round("total_link_length_km", 6).alias("len")]
        same(spark.read.parquet(str(tmp_path / "merged" / role)).where(bounded).select(*cols), whole.where(bounded).select(*cols))


def test_fan_out_writes_every_sink(spark, tmp_path):
    df = spark.range(5)
    writers.fan_out(df, [
        lambda d: d.write.json(str(tmp_path / "a")), lambda d: d.write.parquet(str(tmp_path / "b")),
    ])
    assert spark.read.parquet(str(tmp_path / "b")).count() == 5
    assert not df.is_cached
    assert table_or_empty(spark, str(tmp_path / "c"), df.schema).isEmpty()


@pytest.mark.parametrize("cut", [1, 3])
def test_merge_is_independent_of_minute_aligned_batches(spark, sf, cut):
    from roadpulse.plans import inputs

    totals = runtime.minute_totals(inputs.events(spark, sf))
    part = (F.unix_timestamp("minute") / 60).cast("bigint") % cut
    pieces = [runtime.batch_stats(totals.where(part == i)) for i in range(cut)]
    merged_parts = pieces[0]
    for p in pieces[1:]:
        merged_parts = merged_parts.unionByName(p)
    shape = ["road_id", "hour", "count", F.round("mean", 6).alias("mean"), F.round("m2", 4).alias("m2")]
    same(runtime.merge_stats(merged_parts).select(*shape), runtime.batch_stats(totals).select(*shape))
