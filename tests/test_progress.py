"""The listener's rows of real queries, and the component table made of them."""

from __future__ import annotations

import time
from datetime import datetime, timezone

from pyspark.sql import functions as F
from tests.test_stream import event, land

from roadpulse.operators import operations
from roadpulse.operators.events import parse_events
from roadpulse.sources import streams
from roadpulse.sources.tables import list_files
from roadpulse.streaming import medallion, merged, progress
from roadpulse.streaming.medallion import Layout


def wait_for(spark, root, condition, seconds=30):
    """The listener's bus runs beside the query."""
    end = time.monotonic() + seconds
    while time.monotonic() < end:
        rows = progress.read_progress(spark, [root]).collect()
        if condition(rows):
            return rows
        time.sleep(0.5)
    raise AssertionError(f"no such progress: {rows}")


def test_progress_of_running_queries_is_stored_and_shown(spark, tmp_path):
    layout = Layout(str(tmp_path / "out"), component="traffic")
    folder = tmp_path / "in"
    land(spark, folder, [event(1, 0), event(2, 1)])
    land(spark, folder, [event(3, 60)], start=2)
    listener = progress.ProgressLog(spark, layout.root, {"traffic", "updates", "broken"})
    spark.streams.addListener(listener)
    try:
        source = streams.landed_events(spark, str(folder), max_files=1)
        medallion.run_medallion(source, layout, str(tmp_path / "ck"), available_now=True, name="traffic").awaitTermination()
        events = parse_events(streams.landed_events(spark, str(folder), max_files=1))
        grouped = merged.closed_minutes(events).writeStream.outputMode("append").format("memory").queryName("updates")
        grouped.option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start().awaitTermination()

        def fail(batch, batch_id):
            raise ValueError("sink is down")

        broken = source.writeStream.foreachBatch(fail).queryName("broken").trigger(availableNow=True).start()
        try:
            broken.awaitTermination()
        except Exception:
            pass
        rows = wait_for(spark, layout.root, lambda r: sum(x.error is not None for x in r) == 3)
    finally:
        spark.streams.removeListener(listener)
    of = lambda name: sorted((r for r in rows if r.component == name and r.error is None), key=lambda r: r.batch_id)
    assert [(r.batch_id, r.rows_read) for r in of("traffic")] == [(0, 2), (1, 1)]
    assert max(r.state_rows for r in of("updates")) >= 1 and any(r.watermark is not None for r in of("updates"))
    assert any(r.newest_event is not None for r in of("updates")) and all(r.state_bytes > 0 for r in of("updates"))
    log = {r.batch_id: r.total_events for r in medallion.run_log(spark, layout).collect()}
    assert {r.batch_id: r.rows_read for r in of("traffic")} == log

    now = F.lit(datetime.now(timezone.utc)).cast("timestamp")
    files = list_files(spark, [layout.path("gold")]).withColumn("table", F.lit("gold"))
    shown = operations.component_metrics(progress.component_rows(progress.read_progress(spark, [layout.root]), now, files=files))
    table = {r.component: r for r in shown.collect()}
    assert {c: r.status for c, r in table.items()} == {"traffic": "stopped", "updates": "stopped", "broken": "error", "gold": "ok"}
    assert table["gold"].storage not in (None, "N/A") and table["gold"].latency is not None
    fresh = operations.pipeline_freshness(medallion.run_log(spark, layout), F.lit(time.time())).collect()
    assert [(r.component, r.status) for r in fresh] == [("traffic", "ok")]


def test_delay_and_load_come_from_the_newest_trigger(spark):
    at = lambda second: datetime(2024, 1, 1, 10, 0, second, tzinfo=timezone.utc)
    schema = ", ".join(progress.PROGRESS.split(", ")[:-1])
    made = [("q", "r", 1, at(0), 10, 1.0, 4.0, 500, 1, 1 << 20, 0, None, None, None, "q"),
            ("q", "r", 2, at(30), 10, 3.0, 4.0, 500, 1, 2 << 20, 0, at(0), at(20), None, "q")]
    rows = progress.component_rows(spark.createDataFrame(made, schema), F.lit(at(59)))
    (row,) = operations.component_metrics(rows).collect()
    assert (row.component, row.status, row.memory, row.cpu) == ("q", "ok", "2.0 MB", "75.0%")
    later = progress.component_rows(spark.createDataFrame(made, schema), F.lit(at(30)) + F.expr("INTERVAL 4 MINUTES"))
    assert [r.status for r in operations.component_metrics(later).collect()] == ["delayed"]
