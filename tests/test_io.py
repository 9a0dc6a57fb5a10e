"""Files: raw counts, profile tables, exports, recent files and gold windows."""

from __future__ import annotations

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from roadpulse.plans import inputs
from roadpulse.operators.cleaning import MissingColumns
from roadpulse.plans.profile_job import _block_number, build_profiles, clean_job, with_file_order
from roadpulse.plans.scoring_job import score
from roadpulse.operators.operations import table_freshness
from roadpulse.sinks import writers
from roadpulse.operators import profiles as profile_ops
from roadpulse.sinks.profiles import export_profiles, read_profile, road_documents
from roadpulse.sources import driver_tables as src
from roadpulse.sources import tables
from roadpulse.sources.counts import find_raw_file, read_clean_counts, read_raw_counts
from tests.conftest import rows


@pytest.fixture(scope="module")
def raw_folder(spark, sf, tmp_path_factory):
    """One raw CSV, in the folder layout of the source."""
    folder = tmp_path_factory.mktemp("raw")
    part = folder / "part"
    src.raw_counts(spark, sf).drop("record_ord").coalesce(1).write.option("header", True).csv(str(part))
    file = next(part.glob("*.csv"))
    (folder / "dft_traffic_counts.csv").write_bytes(file.read_bytes())
    (folder / "aaa.csv").write_text("road_name\nother\n")
    return folder


@pytest.fixture(scope="module")
def built(spark, raw_folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("built")
    clean_job(spark, str(raw_folder), str(root / "clean"), folders="yyyy")  # few folders for few rows
    build_profiles(spark, str(root / "clean"), str(root / "profiles"))
    return root


def test_the_known_file_is_chosen(spark, raw_folder):
    assert find_raw_file(spark, str(raw_folder)).endswith("/dft_traffic_counts.csv")
    df = read_raw_counts(spark, str(raw_folder))
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}


def test_profile_job_writes_every_table(spark, built):
    clean = read_clean_counts(spark, str(built / "clean"))
    assert "region_id" not in clean.columns and dict(clean.dtypes)["observation_date"] == "date"
    root = str(built / "profiles")
    meta = rows(read_profile(spark, root, "meta"))[0]
    assert meta["road_count"] == read_profile(spark, root, "road_profile").count() > 0
    assert meta["region_count"] == read_profile(spark, root, "region_profile").count() == 5
    mix = read_profile(spark, root, "road_mix").groupBy("road_id", "dim").agg(F.sum("weight").alias("w"))
    assert mix.where(F.abs(F.col("w") - 1) > 1e-9).isEmpty()
    whole = read_profile(spark, root, "region_mix").groupBy("region_name", "dim").agg(F.sum("weight").alias("w"))
    assert whole.where((F.col("dim") != "road") & (F.abs(F.col("w") - 1) > 1e-9)).isEmpty()
    assert whole.where((F.col("dim") == "road") & (F.col("w") > 1 + 1e-9)).isEmpty()


def test_exports_hold_every_road_once(spark, built, tmp_path):
    root = str(built / "profiles")
    export_profiles(spark, root, str(tmp_path / "out"))
    exported = spark.read.json(str(tmp_path / "out" / "roads"))
    assert exported.select("road_id").distinct().count() == exported.count() == road_documents(spark, root).count()
    assert spark.read.json(str(tmp_path / "out" / "regions")).count() == 5
    meta = {r.region_slug: r for r in spark.read.json(str(tmp_path / "out" / "meta")).collect()}
    sizes = {r.region_slug: r["count"] for r in exported.groupBy("region_slug").count().collect()}
    assert {s: r.road_count for s, r in meta.items()} == sizes and all(r.region_count == 1 for r in meta.values())
    assert all(r.slice_region_id == f"region:{s}" and r.source == "spark" and r.generated_at for s, r in meta.items())
    index = spark.read.json(str(tmp_path / "out" / "index"))
    both = index.select("region_slug", F.col("id").alias("road_id"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, exported.select("region_slug", "road_id").collect()))


def test_slices_keep_copies_of_unknown_roads_and_skip_empty_regions(spark):
    roads = spark.createDataFrame([("r1", "new", 1.0), ("r2", "two", 2.0)], "road_id string, road_name string, rate double")
    copies = spark.createDataFrame(
        [("a", "r1", "old", 9.0), ("a", "r9", "own", 3.0), ("b", "r2", None, None)], "region_id string, road_id string, road_name string, rate double")
    inside = profile_ops.slice_roads(roads, copies)
    assert sorted(map(tuple, inside.collect())) == [("a", "r1", "new", 1.0), ("a", "r9", "own", 3.0), ("b", "r2", "two", 2.0)]
    index = spark.createDataFrame([("r1", "x"), (" r1 ", "y"), ("r2", "z"), ("", "none"), (None, "none"), ("r7", "far")], "id string, road_name string")
    assert sorted(map(tuple, profile_ops.slice_index(index, inside).collect())) == [("a", " r1 ", "y"), ("b", "r2", "z")]
    regions = spark.createDataFrame([("a", "A "), ("b", ""), ("c", "No roads"), ("", "No id"), (None, "No id")], "region_id string, region_name string")
    meta = spark.createDataFrame([("spark", 5, 70, 3)], "source string, region_count long, road_count long, segment_count long")
    got = profile_ops.slice_meta(meta, regions, inside).orderBy("region_id").collect()
    assert [r.asDict() for r in got] == [
        {"region_id": "a", "source": "spark", "segment_count": 3, "region_count": 1, "road_count": 2, "slice_region_id": "a", "slice_region_name": "A"},
        {"region_id": "b", "source": "spark", "segment_count": 3, "region_count": 1, "road_count": 1, "slice_region_id": "b", "slice_region_name": "b"}]


def test_scoring_reads_the_first_root_that_exists(spark, sf, built, tmp_path):
    requests = inputs.requests(spark, sf)
    out = score(spark, requests, [str(tmp_path / "none"), str(built / "profiles")], with_distribution=True)
    got = rows(out.groupBy("status").count(), "status")
    assert [r["status"] for r in got] == ["not_found", "ok"] and sum(r["count"] for r in got) == requests.count()
    with pytest.raises(FileNotFoundError):
        score(spark, requests, [str(tmp_path / "none")])


def test_clean_csv_round_trip(spark, built, tmp_path):
    clean = read_clean_counts(spark, str(built / "clean"))
    writers.write_clean_counts(clean, str(tmp_path / "csv"), form="csv")
    back = read_clean_counts(spark, str(tmp_path / "csv"), form="csv")
    cols = ["road_name", "observation_date", "hour_of_day", "all_motor_vehicle_count"]
    total = lambda df: rows(df.select(*cols).agg(F.count("*").alias("n"), F.sum(F.hash(*cols).cast("bigint")).alias("h")))
    assert total(clean) == total(back)


def test_recent_files_and_broken_lines(spark, tmp_path):
    for i in range(4):
        folder = tmp_path / ("a" if i % 2 else "b")
        folder.mkdir(exist_ok=True)
        f = folder / f"f{i}.jsonl"
        f.write_text('{"n": %d}\n\nnot json\n' % i)
        os.utime(f, (1000 + i, 1000 + i))
    deep = tmp_path / "a" / "x" / "y" / "z"
    deep.mkdir(parents=True)
    (deep / "deep.jsonl").write_text('{"n": 99}\n')
    roots = [str(tmp_path), str(tmp_path / "a")]
    os.utime(deep / "deep.jsonl", (1002.5, 1002.5))
    names = [r["path"].rsplit("/", 1)[1] for r in tables.recent_files(spark, roots, 2, max_depth=2).collect()]
    assert names == ["f2.jsonl", "f3.jsonl"]
    # Any depth by default, and absent roots are skipped.
    roots.append(str(tmp_path / "absent"))
    names = {r["path"].rsplit("/", 1)[1] for r in tables.list_files(spark, roots).collect()}
    assert names == {"f0.jsonl", "f1.jsonl", "f2.jsonl", "f3.jsonl", "deep.jsonl"}
    schema = spark.createDataFrame([(1,)], "n bigint").schema
    since = datetime.fromtimestamp(1002, timezone.utc)
    kept = tables.read_recent(spark, [str(tmp_path), str(tmp_path / "absent")], schema, since)
    assert {r["n"] for r in rows(kept)} == {2, 3, 99}
    assert tables.read_recent(spark, [str(tmp_path / "absent")], schema, since).isEmpty()
    files = tables.list_files(spark, [str(tmp_path)], max_depth=2).select(F.lit("t").alias("table"), "modified", "size")
    fresh = rows(table_freshness(files, F.lit(1100)))[0]
    assert (fresh["status"], fresh["lag_seconds"], fresh["human_lag"]) == ("ok", 97.0, "1m 37s")


def test_gold_window_lists_only_its_hours(spark, sf, tmp_path):
    gold, path = inputs.gold_rows(spark, sf), str(tmp_path / "gold")
    writers.write_gold(gold, path, 0)
    newest = gold.agg(F.max("event_timestamp").alias("m")).first()["m"]
    window = tables.read_gold_window(spark, path, 180, newest)
    want = gold.where(F.col("event_timestamp") >= F.lit(newest) - F.expr("interval 180 minutes")).count()
    assert window.count() == want > 0
    files = len(window.inputFiles())
    # A hundred batches of the days before add no file to the window.
    old = gold.limit(3).withColumn("event_timestamp", F.col("event_timestamp") - F.expr("interval 5 days"))
    rows_of_many = old.withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(100)))).withColumns({
        "dt": F.date_format("event_timestamp", "yyyyMMdd"), "hour": F.date_format("event_timestamp", "HH"), "batch_id": F.col("b")}).drop("b")
    rows_of_many.write.mode("append").partitionBy("dt", "hour", "batch_id").parquet(path)
    again = tables.read_gold_window(spark, path, 180, newest)
    assert len(again.inputFiles()) == files and again.count() == want
    assert tables.read_gold_window(spark, str(tmp_path / "none"), 180, newest).isEmpty()
    assert tables.read_gold_window(spark, path, 180, None).count() == gold.count() + 300


def test_null_texts_of_clean_csv(spark, tmp_path):
    (tmp_path / "clean.csv").write_text(
        "road_name,all_motor_vehicle_count,hour_of_day,observation_date,start_junction_road_name,extra\n"
        "A1,5,7,2020-01-02,NA,<NA>\nNULL,N/A,8,2020-01-02,Nan,x\n")
    got = rows(read_clean_counts(spark, str(tmp_path / "clean.csv"), form="csv"), "hour_of_day")
    assert [(r["road_name"], r["all_motor_vehicle_count"], r["start_junction_road_name"], r["extra"]) for r in got] == [
        ("A1", 5.0, None, None), (None, None, "Nan", "x")]


def test_file_order_is_the_order_of_the_lines(spark, tmp_path):
    lines = [f"row {i:06d} {'x' * (i % 50)}" for i in range(40_000)]
    (tmp_path / "b.csv").write_text("text\n" + "\n".join(lines[20_000:]) + "\n")
    (tmp_path / "a.csv").write_text("text\n" + "\n".join(lines[:20_000]) + "\n")
    got = with_file_order(spark.read.option("header", True).csv(str(tmp_path))).repartition(5).orderBy("record_ord").collect()
    assert [r["text"] for r in got] == lines


def test_file_order_of_more_files_than_ten_bits_hold(spark, tmp_path):
    for n in range(1030):
        (tmp_path / f"f{n:04d}.csv").write_text(f"text\nrow {n:04d}\n")
    got = with_file_order(spark.read.schema("text string").option("header", True).csv(str(tmp_path))).orderBy("record_ord").collect()
    assert [r["text"] for r in got] == [f"row {n:04d}" for n in range(1030)]


def test_a_block_that_has_no_order_number_raises(spark):
    def numbers(files, *places):
        frame = spark.createDataFrame(places, "file bigint, start bigint")
        return [r[0] for r in frame.select(_block_number(F.col("file"), F.col("start"), files)).collect()]

    tib = 1 << 40
    assert numbers(1, (0, 5 * tib)) == [5 * tib >> 20 << 33]  # one file beyond 1 TiB
    found = numbers(1025, (0, tib // 2 - 1), (1, 0), (1024, 0))
    assert found == sorted(found) and found[0] > 0
    with pytest.raises(Exception, match="no order number"):
        numbers(1025, (0, tib // 2))


def test_profiles_need_an_order(spark, tmp_path):
    spark.createDataFrame([("A1", 1.0, 7, "2020-01-01")], "road_name string, all_motor_vehicle_count double, hour_of_day int, observation_date string") \
        .write.parquet(str(tmp_path / "clean"))
    with pytest.raises(MissingColumns, match="record_ord"):
        build_profiles(spark, str(tmp_path / "clean"), str(tmp_path / "out"))


def test_index_lists_both_names_of_an_id(spark, built):
    index = rows(read_profile(spark, str(built / "profiles"), "road_index").where("id = 'road:a-7'"), "road_name")
    assert [r["road_name"] for r in index] == ["A 7", "A-7"]
    assert rows(read_profile(spark, str(built / "profiles"), "road_profile").where("road_id = 'road:a-7'"))[0]["road_name"] == "A-7"
