"""Sharding, mixing, search, and the pipeline; every SQL twin of the subpackage."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import hash_mix, histogram_shards, pigeon_simhash, tput_search
from roadpulse.llm import queries as q
from roadpulse.llm.oracle import oracle_sql
from tests.compare import compare, connect
from tests.llm.conftest import ROWS
from tests.llm.test_text_operators import plain_components, plain_contamination, plain_fingerprint, plain_tokens


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_matches_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, sf) is None


def test_registered():
    names = list(q.queries())
    assert [n.split("_")[0] for n in names] == [f"op{n}" for n in range(1, 14)]
    assert set(oracle_sql()) <= set(names)


# Sharding


def check_shards(rows, shards, tolerance):
    """rows: (size, shard, slot). Sizes near equal, slots gapless."""
    sizes, slots = Counter(), defaultdict(list)
    for size, shard, slot in rows:
        sizes[shard] += size
        slots[shard].append(slot)
    assert set(slots) <= set(range(shards))
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    ideal, largest = sum(sizes.values()) / shards, max(r[0] for r in rows)
    for shard in range(shards):
        assert abs(sizes[shard] - ideal) <= 2 * max(tolerance * ideal, largest)


def test_shards(spark, sf, documents):
    got = q.queries()["op4_histogram_shards"](spark, sf).collect()
    docs = {r.doc_id: r.text for r in documents.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {
        d: (len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in docs.items()}
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    check_shards([(r["size"], r.shard, r.slot) for r in got], 40, histogram_shards.TOLERANCE)


def test_shards_with_one_large_group(spark):
    # A third of all rows is one text; a document is far smaller than the tolerance of a shard.
    rows = [(n, "the same text" if n % 3 == 0 else f"text number {n:05d}") for n in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = histogram_shards.shard(frame, 8, 0.02).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    ideal = sum(sizes.values()) / 8
    assert all(abs(sizes[s] - ideal) <= 0.05 * ideal for s in range(8))
    check_shards([(r["size"], r.shard, r.slot) for r in got], 8, 0.02)
    # Only the large group is split.
    shards = defaultdict(set)
    for r in got:
        shards[r.text_crc32].add(r.shard)
    assert [len(s) for s in shards.values() if len(s) > 1] == [len(shards[zlib.crc32(b"the same text")])]


def test_small_groups_stay_whole(spark):
    rows = [(n, f"text {n // 4} " * 3) for n in range(4000)]
    got = histogram_shards.shard(spark.createDataFrame(rows, "doc_id long, text string"), 10, 0.01).collect()
    shards = defaultdict(set)
    for r in got:
        shards[r.text_crc32].add(r.shard)
    assert max(map(len, shards.values())) == 1


def test_shards_odd(spark, odd, none):
    got = histogram_shards.shard(odd, 3).collect()
    assert len(got) == len(ROWS) and {r["size"] for r in got if r.text_crc32 is None} == {16}
    check_shards([(r["size"], r.shard, r.slot) for r in got], 3, histogram_shards.TOLERANCE)
    assert histogram_shards.shard(none, 3).count() == 0
    same = spark.createDataFrame([(7, "x")] * 50, "doc_id long, text string")
    assert histogram_shards.shard(same, 4).count() == 50


# Mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    left, target, open_names = float(sum(sizes.values())), {}, set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_names) for s in open_names}
        full = [s for s in open_names if share[s] >= most * sizes[s]]
        if not full:
            return target | share
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
            open_names.discard(s)
        if not open_names:
            return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 40, "d": 0}, {"a": 7}, {"a": 0, "b": 0}, {"a": 1, "b": 1, "c": 1}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in hash_mix.source_targets(frame).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)


def test_mix(spark, odd, none):
    rows = [(n, "w " * (n % 37), "hot" if n % 3 else ["s1", "s2", None, "s4"][n % 4]) for n in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = hash_mix.mix(frame).collect()
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        targets[r.source] = r.target
        assert r.taken <= 3 * r["size"] and r["size"] == r.doc_id % 37
    want = plain_targets(sizes)
    assert all(math.isclose(targets[s], want[s], rel_tol=1e-9) for s in want)
    assert all(abs(taken[s] - targets[s]) <= 36 for s in want)
    again = hash_mix.mix(frame.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)
    copies = Counter(r.doc_id for r in hash_mix.repeat_rows(frame).collect())
    assert copies == {r.doc_id: r.times for r in got if r.times}
    assert hash_mix.mix(odd).count() == len(ROWS) and hash_mix.repeat_rows(odd).columns == odd.columns
    assert hash_mix.mix(none).count() == 0 and hash_mix.repeat_rows(none).count() == 0


def test_mix_is_nested(spark, documents):
    light, heavy = ({r.doc_id: r.times for r in hash_mix.mix(documents.withColumn("source", F.when(
        F.col("doc_id") % 2 == 0, "a").otherwise("b")), w).collect()} for w in ((1, 3), (2, 2)))
    assert all(light[d] <= heavy[d] for d in light if d % 2 == 0)


# Search


def plain_search(rows, step, k):
    good = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, v in good.items():
        if a % step == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), b) for b, w in good.items() if b != a)
            out += [(a, n + 1, b, -s) for n, (s, b) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block, lists", [(2048, 2), (3, 5)])
def test_search(spark, block, lists):
    rng = np.random.default_rng(9)
    rows = [(n, rng.integers(-3, 4, 6).astype(float).tolist()) for n in range(300)]  # many ties
    rows += [(300, None), (301, []), (302, [1.0, None]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (None, [1.0] * 6),
             (305, [2.0] * 3), (310, [1e6] * 6), (20, rows[20][1])]
    frame = tput_search.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = tput_search.search(frame, frame.where("vec_id % 10 = 0"), 5, lists, block)
    assert sorted(tuple(r) for r in got.collect()) == plain_search(rows, 10, 5)


def test_search_small(spark):
    empty = tput_search.scaled(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert tput_search.search(empty, empty).count() == 0
    two = tput_search.scaled(spark.createDataFrame([(0, [1.0]), (50, [2e13])], "vec_id long, embedding array<double>"))
    assert [tuple(r) for r in tput_search.search(two, two.where("vec_id = 0")).collect()] == [(0, 1, 50, 256 * 256 * 2 * 10**13)]


@pytest.mark.parametrize("block", [2048, 1])
def test_search_different_vectors_of_one_id(spark, block):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [3.0, 1.0]), (1, [1.0, 5.0]), (1, [3.0, 1.0]), (2, [2.0, 2.0])]
    frame = tput_search.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = tput_search.search(frame, frame.where("vec_id = 0"), 4, block=block).collect()
    # (0, 2) scores 10, 2 and 4; (1, 0) scores 3, 1 and 2.
    assert sorted((r.query_id, r.rank, r.vec_id, r.score // 65536) for r in found) == [(0, 1, 1, 10), (0, 2, 2, 4), (0, 3, 1, 3), (0, 4, 1, 2)]


# Pipeline


def test_pipeline(spark, sf, documents):
    from tokenizers import Tokenizer

    from roadpulse.llm import zstd_toxicity

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    bench = [(str(i), t) for i, t in bench]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    # The plain version takes the fitted dictionaries as given and redoes every decision.
    model = zstd_toxicity.fit(documents, labels, lambda c: F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(False)))
    gains = zstd_toxicity.Gains(model)
    docs = {r.doc_id: r for r in documents.collect()}
    clean = {d: r for d, r in docs.items() if zstd_toxicity._score(model, np.array([gains(r.text)], float))[0] < 0.7}
    names = plain_components({d: plain_fingerprint(r.text) for d, r in clean.items()})
    single = [r for d, r in clean.items() if names[d] == d]
    kept = [r for r in single if not plain_contamination(r.text, bench)[3]]
    frame = spark.createDataFrame(kept, documents.schema)
    times = {r.doc_id: r.times for r in hash_mix.mix(frame).collect()}
    rows = sorted(r.doc_id for r in kept for _ in range(times[r.doc_id]))
    tokenizer = Tokenizer.from_file(q.byte_bpe())
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == plain_tokens([(d, docs[d].text) for d in rows], tokenizer)
    assert 0 < len(kept) < len(docs)


def test_stages(spark, sf, odd, none):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf).columns == odd.columns
        assert stage(spark, none, sf).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == len(ROWS)


def test_near_dedup_stage_on_near_copies(spark, sf, monkeypatch):
    """Texts that differ in one word: one of each component stays, and a group twice as large gives no four times the links."""
    made, components = [], pigeon_simhash.components

    def counted(links):
        made.append(links.count())
        return components(links)

    monkeypatch.setattr(pigeon_simhash, "components", counted)
    for size in (60, 120):
        rows = [(n, " ".join(f"other{n}" if at == 3 * n + 1 else f"word{at}" for at in range(400))) for n in range(size)]
        names = plain_components({n: plain_fingerprint(text) for n, text in rows})
        kept = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(names.values()))
    assert made[1] < 3 * made[0]
