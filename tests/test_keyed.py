"""Keyed running statistics against the table form, and roads that fall silent."""

from __future__ import annotations

import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import same
from tests.test_stream import event, land, run

from roadpulse.operators.events import parse_events
from roadpulse.sources import driver_tables as src
from roadpulse.sources import streams
from roadpulse.streaming import keyed, state
from roadpulse.streaming.medallion import Layout



def numbers(stats):
    return {(r.road_id, r.hour): (r["count"], r.mean, r.m2) for r in stats.collect()}


def drive(spark, folder, root, checkpoint, files=1, **more):
    events = parse_events(streams.landed_events(spark, str(folder), max_files=files))
    keyed.run_road_state(events, root, str(checkpoint), available_now=True, **more).awaitTermination()


@pytest.mark.parametrize("files", [1, 3])
def test_keyed_state_equals_the_table_form(spark, sf, tmp_path, files):
    raw = src.raw_events(spark, sf)
    for i in range(3):
        raw.where(F.col("offset") % 3 == i).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    root = str(tmp_path / "keyed")
    drive(spark, tmp_path / "in", root, tmp_path / "ck", files)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    layout = Layout(str(tmp_path / "out"))
    run(spark, tmp_path / "in", layout, tmp_path / "ck2", max_files=files)
    for fold in (False, True):
        if fold:
            keyed.fold_road_state(spark, root)
        got = {n: keyed.read_road_state(spark, root, n) for n in ("stats", "directions", "meta")}
        own, want = numbers(got["stats"]), numbers(state.read_state(spark, layout.path("state"), "stats"))
        assert own.keys() == want.keys() and len(own) == got["stats"].count()
        for key, values in want.items():
            assert own[key] == pytest.approx(values, rel=1e-9, abs=1e-6)
        for name in ("directions", "meta"):
            want = state.read_state(spark, layout.path("state"), name)
            same(got[name].select(*want.columns), want)


def test_a_silent_road_is_forgotten_and_starts_anew(spark, tmp_path):
    root, folder = str(tmp_path / "keyed"), tmp_path / "in"
    silent = timedelta(seconds=1)

    def counts():
        rows = keyed.read_road_state(spark, root, "stats").where("hour IS NULL").collect()
        return {r.road_id: r["count"] for r in rows}

    land(spark, folder, [event(1, 0), event(2, 1), event(3, 0, road="r2")])
    drive(spark, folder, root, tmp_path / "ck", silent=silent)
    assert counts() == {"r1": 2, "r2": 1}
    time.sleep(1.5)
    land(spark, folder, [event(4, 2, road="r2"), event(5, 2, road="r3")], start=3)
    drive(spark, folder, root, tmp_path / "ck", silent=silent)
    # r1 is gone, r2 came back after its time and starts anew.
    assert counts() == {"r2": 1, "r3": 1}
    keyed.fold_road_state(spark, root)
    assert counts() == {"r2": 1, "r3": 1}
    assert {r.road_id for r in keyed.read_road_state(spark, root, "directions").collect()} == {"r2", "r3"}


def test_a_road_that_keeps_sending_stays(spark, tmp_path):
    root, folder = str(tmp_path / "keyed"), tmp_path / "in"
    for i in range(3):
        land(spark, folder, [event(i, i), event(10 + i, i, road="")], start=2 * i)
        drive(spark, folder, root, tmp_path / "ck", silent=timedelta(days=1))
    (row,) = keyed.read_road_state(spark, root, "stats").where("hour IS NULL").collect()
    assert (row.road_id, row["count"], row.mean) == ("r1", 3, 10.0)
    with pytest.raises(ValueError):
        keyed.road_changes(parse_events(streams.landed_events(spark, str(folder))), silent=timedelta(0))
