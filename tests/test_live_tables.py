"""Open minutes in versions, and stored predictions against closed minutes."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import gold, scoring
from roadpulse.operators.events import parse_events
from roadpulse.plans.scoring_job import store_predictions
from roadpulse.schemas import RAW_EVENT
from roadpulse.sources import streams
from roadpulse.streaming import merged, predictions
from tests.test_stream import ADDITIVE, T0, event, land


def picture(df, keys):
    return sorted(map(str, df.select(*keys, "event_timestamp", *ADDITIVE, F.round("total_link_length_km", 6), F.round("vehicles_per_km", 6)).collect()))


def test_open_minutes_are_readable_and_end_as_the_closed_ones(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "updates")

    def run(query):
        query(parse_events(streams.landed_events(spark, str(folder), max_files=1))).awaitTermination()

    def update(events):
        return merged.run_gold_updates(events, root, str(tmp_path / "ck"), available_now=True)

    land(spark, folder, [event(1, 0, count=4), event(2, 1, count=5, local_authority_name="B")])
    run(update)
    assert [r.total_vehicles for r in merged.read_updates(spark, root).orderBy("event_timestamp").collect()] == [4, 5]
    land(spark, folder, [event(3, 0, count=6, link_length_kilometers=7.0, local_authority_name="B"), event(4, 0, road="r2", count=1)], start=2)
    run(update)
    (first, _) = merged.read_updates(spark, root).orderBy("event_timestamp").collect()
    # One road in two authorities has one length in its region.
    assert (first.total_vehicles, first.event_count, first.total_link_length_km) == (11, 3, 9.0)
    land(spark, folder, [event(9, 600)], start=9)
    run(update)
    for role, keys in (("primary", ["region_name"]), ("authority", ["region_name", "local_authority_name"]), ("road", ["region_name", "local_authority_name", "road_key"])):
        name = f"closed_{role}"
        run(lambda events, role=role, name=name: merged.gold_merged(events, role).writeStream.outputMode("append").format("memory").queryName(name).trigger(
            availableNow=True).option("checkpointLocation", str(tmp_path / name)).start())
        bounded = F.col("event_timestamp") < F.lit(T0 + timedelta(hours=1))
        closed = spark.table(name)
        assert picture(merged.read_updates(spark, root, role).where(bounded), keys) == picture(closed, keys) and closed.count() > 1
    whole = gold.gold_region(parse_events(spark.read.schema(RAW_EVENT).json(str(folder))))
    assert picture(merged.read_updates(spark, root), ["region_name"]) == picture(whole, ["region_name"])


@pytest.mark.parametrize("files", [1, 10])
def test_prediction_errors_equal_the_batch_form(spark, tmp_path, files):
    region, at = "North East", lambda m: T0 + timedelta(minutes=m)
    for n in range(5):
        land(spark, tmp_path / "in", [event(10 * n + k, n + 5 * (k % 2), count=3 * n + k) for k in range(4)], start=10 * n)
    land(spark, tmp_path / "in", [event("end", 5000)], start=100)
    made = [(region, at(m), at(m - lead), float(7 * m % 23 + 3 * lead)) for m in (0, 1, 2, 5, 6, 40) for lead in range(1, 16)]
    made += [("Elsewhere", at(0), at(-1), 5.0), (region, at(5000), at(0), 1.0), (region, None, at(0), 1.0), (region, at(3), at(2), None)]
    for part in (made[::2], made[1::2]):
        store_predictions(spark.createDataFrame(part, predictions.PREDICTIONS).select("region_name", "target_ts", "generated_at", "value").coalesce(1), str(tmp_path / "made"))
    store_predictions(spark.createDataFrame([(region, at(9000), at(0), 1.0)], predictions.PREDICTIONS), str(tmp_path / "made"))
    events = parse_events(streams.landed_events(spark, str(tmp_path / "in"), max_files=files))
    predictions.run_prediction_errors(
        events, predictions.prediction_stream(spark, str(tmp_path / "made"), max_files=files), str(tmp_path / "pairs"), str(tmp_path / "ck"),
        watermark="2 days", available_now=True).awaitTermination()
    pairs = predictions.read_errors(spark, str(tmp_path / "pairs"))
    stored = parse_events(spark.read.schema(RAW_EVENT).json(str(tmp_path / "in"))).where("event_id <> 'eend'")
    series = gold.gold_region(stored).select("region_name", F.col("event_timestamp").alias("minute"), F.col("total_vehicles").cast("double").alias("value"))
    kept = scoring.kept_predictions(spark.read.schema(predictions.PREDICTIONS).parquet(str(tmp_path / "made")), ["region_name"], as_of=F.lit(T0))
    want = scoring.worst_prediction(series, kept, ["region_name"])
    assert sorted(map(str, predictions.worst_stored(pairs).collect())) == sorted(map(str, want.collect())) and want.count() == 5
    assert sorted(r.minute.minute for r in predictions.unpredicted(pairs).collect()) == [3, 4, 7, 8, 9]
