"""Increments per refresh of a second stream against the batch query."""

from __future__ import annotations

from tests.conftest import same
from tests.test_stream import event, land, run

from roadpulse.operators.analytics import batch_increment
from roadpulse.streaming import increments
from roadpulse.streaming.medallion import Layout, read_gold
from roadpulse.sources.tables import table_or_empty


def test_increments_equal_the_batch_query_and_repeat_nothing(spark, tmp_path):
    layout, root = Layout(str(tmp_path / "out"), failover=str(tmp_path / "spare")), str(tmp_path / "sums")

    def refresh(files):
        increments.run_increments(spark, layout, root, str(tmp_path / "ck2"), max_files=files, available_now=True).awaitTermination()

    land(spark, tmp_path / "in", [event(1, 0), event(2, 70, road="r2", region_name="Wales"), event(3, 1, count=0)])
    run(spark, tmp_path / "in", layout, tmp_path / "ck")
    refresh(1)
    land(spark, tmp_path / "in", [event(4, 71, count=7), event(5, 3, count=2)], start=3)
    run(spark, tmp_path / "in", layout, tmp_path / "ck")
    refresh(10)
    refresh(10)
    got = increments.read_increments(spark, layout, root)
    same(got, batch_increment(read_gold(spark, layout)))
    assert got.count() == 2 and increments.read_increments(spark, layout, root, keep=1).first().batch_id == 1
    window = increments.read_increments(spark, layout, root, minutes=15)
    same(window, batch_increment(read_gold(spark, layout, minutes=15)))
    assert {r.batch_id for r in window.collect()} == {0, 1}
    numbers = {r.refresh for r in table_or_empty(spark, root, increments._SUMS).select("refresh").collect()}
    assert len(numbers) >= 2
    # A batch without its run log entry is not complete.
    empty = Layout(str(tmp_path / "elsewhere"))
    assert increments.read_increments(spark, empty, root).isEmpty()
