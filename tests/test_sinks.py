"""Several sinks of one stream, one of which fails for a while."""

from __future__ import annotations

import pytest
from tests.test_stream import event, land

from roadpulse.schemas import RAW_EVENT
from roadpulse.sources import streams
from roadpulse.streaming import sinks


class Sink:
    """Stores batches; fails the first ``fails`` times, half of a batch being written by then."""

    def __init__(self, path, fails=0):
        self.path, self.fails, self.took = str(path), fails, []

    def __call__(self, rows, batch_id):
        target = f"{self.path}/batch_id={batch_id}"
        if self.fails:
            self.fails -= 1
            rows.limit(1).write.mode("overwrite").parquet(target)
            raise OSError("sink is down")
        rows.write.mode("overwrite").parquet(target)
        self.took.append(batch_id)

    def offsets(self, spark):
        return sorted(r.offset for r in spark.read.parquet(self.path).collect())


def drive(spark, tmp_path, both):
    source = streams.landed_events(spark, str(tmp_path / "in"), max_files=1)
    sinks.run_fan_out(source, both, str(tmp_path / "log"), str(tmp_path / "ck"), available_now=True).awaitTermination()


def test_a_sink_that_fails_twice_catches_up_alone(spark, tmp_path):
    for n in range(3):
        land(spark, tmp_path / "in", [event(2 * n, n), event(2 * n + 1, n)], start=2 * n)
    well, ill = Sink(tmp_path / "a"), Sink(tmp_path / "b", fails=2)
    both, log = {"ill": ill, "well": well}, str(tmp_path / "log")
    drive(spark, tmp_path, both)
    # Batch 0 fails, and fails again at the second trigger; the third brings all three, in order.
    assert well.took == [0, 1, 2] and ill.took == [0, 1, 2]
    assert well.offsets(spark) == ill.offsets(spark) == list(range(6))
    assert sinks.committed(spark, log) == {"ill": 2, "well": 2} and sinks.lag(spark, log, both) == {"ill": 0, "well": 0}
    assert sinks.waiting(spark, log) == [0, 1]

    # A batch that runs again reaches nobody twice; later ones reach both.
    sinks.fan_out_batch(spark.createDataFrame([], RAW_EVENT), 2, both, log)
    assert well.took == ill.took == [0, 1, 2] and well.offsets(spark) == list(range(6))
    land(spark, tmp_path / "in", [event(6, 3)], start=6)
    drive(spark, tmp_path, both)
    assert well.took == ill.took == [0, 1, 2, 3]


def test_a_sink_that_is_down_is_brought_up_to_date_later(spark, tmp_path):
    for n in range(2):
        land(spark, tmp_path / "in", [event(n, n)], start=n)
    well, ill = Sink(tmp_path / "a"), Sink(tmp_path / "b", fails=99)
    both, log = {"well": well, "ill": ill}, str(tmp_path / "log")
    drive(spark, tmp_path, both)
    assert well.offsets(spark) == [0, 1] and sinks.lag(spark, log, both) == {"well": 0, "ill": 2}
    assert sinks.catch_up(spark, RAW_EVENT, both, log) == {"well": 0, "ill": 2}
    ill.fails = 0
    assert sinks.catch_up(spark, RAW_EVENT, both, log) == {"well": 0, "ill": 0}
    assert ill.took == [0, 1] and ill.offsets(spark) == [0, 1] and well.took == [0, 1]


def test_sink_names_are_folder_names(spark, tmp_path):
    source = streams.landed_events(spark, str(tmp_path))
    for wrong in ({}, {"a/b": print}, {"": print}):
        with pytest.raises(ValueError):
            sinks.run_fan_out(source, wrong, str(tmp_path / "log"), str(tmp_path / "ck"))
