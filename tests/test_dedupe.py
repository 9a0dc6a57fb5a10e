"""An event id counts once, however long ago it was read."""

from __future__ import annotations

from pyspark.sql import functions as F

from roadpulse.operators.events import parse_events
from roadpulse.streaming import dedupe, medallion
from roadpulse.streaming.medallion import Layout, process_batch
from tests.conftest import rows
from tests.test_stream import batch_of, event, vehicles


def test_an_event_replayed_days_later_counts_once(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"))
    process_batch(batch_of(spark, *[event(n, n, count=1) for n in range(70)]), 0, layout)
    process_batch(batch_of(spark, event(500, 3 * 24 * 60, count=10), start=100), 1, layout)
    # Days later: old ids in two hours, one of them twice, a new id of an old hour, events without an id.
    again = [event(3, 3, count=1), event(3, 3, count=1), event(65, 65, count=1), event(900, 4, count=7), event(500, 3 * 24 * 60, count=10),
             event("x", 5, count=2, event_id=None), event("x", 5, count=2, event_id="")]
    process_batch(batch_of(spark, *again, event(901, 4, count=5), event(901, 4, count=5), start=200), 2, layout)
    assert vehicles(medallion.read_gold(spark, layout)) == 70 + 10 + 7 + 2 + 2 + 5
    log = rows(medallion.run_log(spark, layout), "batch_id")
    assert [(r["total_events"], r["repeated_events"]) for r in log] == [(70, 0), (1, 0), (4, 5)]
    assert spark.read.parquet(layout.path("silver")).count() == 75


def test_filters_hold_every_id_and_few_others(spark, tmp_path):
    count = 9000
    events = parse_events(batch_of(spark, *[event(n, n % 50) for n in range(count)]))
    hours = dedupe.ids_per_hour(events)
    dedupe.write_ids(events, str(tmp_path), 7, hours)
    filters = spark.read.schema(dedupe.FILTERS).parquet(str(tmp_path / "id_filters"))
    (blocks,) = {r.blocks for r in filters.collect()}
    assert blocks == -(-count * dedupe.BITS_PER_ID // dedupe.BLOCK_BITS) and filters.count() == blocks
    asked = spark.range(2 * count).select(F.concat(F.lit("e"), F.col("id")).alias("event_id")).withColumn("block", dedupe._block(F.lit(blocks)))
    hit = asked.join(filters, "block").where(F.forall(dedupe._places(), lambda p: dedupe._bit(F.col("bits"), p)))
    known = F.substring("event_id", 2, 9).cast("int") < count
    assert hit.where(known).count() == count
    assert hit.where(~known).count() < 0.02 * count


def test_repeats_over_two_roots(spark, tmp_path):
    root, away = tmp_path / "root", tmp_path / "away"
    layout = Layout(str(root), failover=str(tmp_path / "spare"))
    process_batch(batch_of(spark, event(1, 0)), 0, layout)
    root.rename(away)
    root.write_text("down")
    process_batch(batch_of(spark, event(2, 0), start=1), 1, layout)
    root.unlink()
    away.rename(root)
    process_batch(batch_of(spark, event(1, 0), event(2, 0), event(3, 0), start=2), 2, layout)
    assert vehicles(medallion.read_gold(spark, layout)) == 30
