"""Operators over texts, each against a plain version of its contract."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.llm import fm_decontam, hyper_lang, line_dedup, pigeon_simhash, quality_bayes, token_files, zstd_toxicity
from roadpulse.llm import queries as q
from roadpulse.llm.common import shared_folder
from tests.llm.conftest import ROWS

SPACE = " \t\n\x0b\x0c\r"
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(q.byte_bpe())


# Token files


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abÀ漢1 .,'<|>\n\t \x1c é")), max_size=30), max_size=4))
def test_pieces_equal_whole_texts(tokenizer, texts):
    encode = token_files._encoder(q.byte_bpe())
    texts = [*texts, "it's  'll we'll, don't", "a <|endoftext|> b<|endoftext|>"]
    ids, counts = encode(pa.array(texts), np.array([2], encode.dtype).tobytes())
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def plain_tokens(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, sf, documents, tokenizer):
    got = sorted(tuple(r) for r in q.queries()["op1_token_files"](spark, sf).collect())
    assert got == plain_tokens([(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()], tokenizer)


def test_token_files_odd(spark, odd, none, tokenizer):
    got = sorted((tuple(r) for r in q.token_rows(odd).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, -8, 1, 1, 2, 3, 4, 5, 6, 7]
    want = Counter((d, n, crc) for d, _, n, crc in plain_tokens([(r[0], r[1]) for r in ROWS], tokenizer))
    assert Counter((r[0], r[2], r[3]) for r in got) == want
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    assert q.token_rows(none).count() == 0


def test_token_files_on_disk(spark, documents):
    folder = shared_folder(spark, "test-tokens")
    manifest = token_files.write_token_files(documents.repartition(3), folder, q.byte_bpe(), 2).orderBy("file_no").collect()
    total, root = 0, folder.removeprefix("file://")
    for row in manifest:
        ids = np.fromfile(f"{root}/{row.ids_file}", "<u2")
        offsets = np.fromfile(f"{root}/{row.offsets_file}", "<u8")
        assert row.base == total and len(ids) == row.n_tokens == offsets[-1] and len(offsets) == row.n_docs + 1
        assert (ids[offsets[1:].astype(int) - 1] == 2).all()
        total += len(ids)


# Line dedup


def plain_lines(rows):
    docs = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(LOWERED)
            if len(key) >= 20:
                docs[key].add(-(1 << 63) if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        at = -(1 << 63) if doc_id is None else doc_id
        keys = [line.strip(SPACE).translate(LOWERED) for line in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(docs.get(k, ())) < 3 or max(docs[k]) == at]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_cases(spark, odd, none):
    line, short = "A line that is kept only once, É", "x" * 19
    rows = [(n, f"{short}\n  {line.lower() if n % 2 else line}\t\r\nown {n} line of more than twenty points\n{line}") for n in range(9)]
    rows += [(100, line), (100, "two documents hold this line"), (101, "two documents hold this line"), (None, line), (102, "\n")]
    rows += [(r[0], r[1]) for r in ROWS]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept.encode()).hexdigest()) for r in line_dedup.dedup_lines(frame).collect()]
    assert sorted(got, key=str) == plain_lines(rows)
    assert line_dedup.dedup_lines(odd).count() == len(ROWS) and line_dedup.dedup_lines(none).count() == 0


def test_line_filters_lose_no_repeat():
    rng = np.random.default_rng(1)
    keys = [rng.integers(0, 1 << 63, 400).astype(np.uint64) for _ in range(40)]
    shared = rng.integers(0, 1 << 63, 50).astype(np.uint64)
    import pandas as pd

    bits = 1 << 16
    rows = []
    for part, own in enumerate(keys):
        once = np.unique(np.concatenate(line_dedup._positions(np.concatenate([own, shared[part % 20 :: 20]]), bits)))
        rows.append((0, part, line_dedup._packed(once, bits), b""))
    frame = pd.DataFrame(rows, columns=["segment", "part", "once", "twice"])
    merge = line_dedup._merge(bits)
    halves = pd.concat([merge(frame.iloc[:20]), merge(frame.iloc[20:])])
    for result in (merge(frame), merge(halves)):
        flags = np.unpackbits(line_dedup._unpacked(result["twice"].iloc[0], bits), bitorder="little").astype(bool)
        assert all(flags[p.astype(int)].all() for p in line_dedup._positions(shared, bits))
        own = np.concatenate(keys)
        assert np.logical_and.reduce([flags[p.astype(int)] for p in line_dedup._positions(own, bits)]).mean() < 0.5


# Decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWERED))


def plain_contamination(text, items, window=13):
    own, hit, found = plain_words(text), set(), set()
    for item, phrase in items:
        words = plain_words(phrase)
        if not words:
            continue
        size = min(window, len(words))
        for at in range(len(words) - size + 1):
            for k in range(len(own) - size + 1):
                if own[k : k + size] == words[at : at + size]:
                    hit.update(range(k, k + size))
                    found.add(item or "")
    return len(own), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(own)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=4),
       st.lists(st.lists(st.sampled_from("abcd"), max_size=8), min_size=1, max_size=4))
def test_fm_index(texts, items):
    named = [(str(n), " ".join(w)) for n, w in enumerate(items)]
    phrases = fm_decontam.Phrases(named, 3)
    document, first, after, window = fm_decontam.shard_hits([[x.encode() for x in t] for t in texts], phrases)
    for n, text in enumerate(texts):
        hit = {k for d, a, b in zip(document, first, after, strict=True) if d == n for k in range(a, b)}
        owners = {o for d, w in zip(document, window, strict=True) if d == n for o in phrases.owners[w]}
        _, count, found, _ = plain_contamination(" ".join(text), named, 3)
        assert (len(hit), sorted(owners)) == (count, found)


def test_contamination_cases(spark, odd, none, monkeypatch):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    items = [("q1", item), ("q1", "Short item"), ("q2", None), (None, "nameless 12 thing"), ("q3", ""), ("q10", item.upper()), ("q4", "ünïcode WÖRDS")]
    texts = [item, "x " + item.replace(" ", "-") + " y", "a short   ITEM!", " ".join(item.split()[:13]), " ".join(item.split()[:12]),
             "word " * 300 + "short item", "word " * 30 + "short item", None, "", "Nameless 12 Thing", *[r[1] for r in ROWS]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = {n: plain_contamination(t, items) for n, t in enumerate(texts)}

    def judged():
        rows = fm_decontam.contamination(frame, bench).collect()
        return {r.doc_id: (r.contamination.n_words, r.contamination.n_hit, list(r.contamination["items"]), r.contamination.contaminated) for r in rows}

    assert judged() == want
    monkeypatch.setattr(fm_decontam, "BLOCK_BYTES", 20)  # many blocks, same result
    assert judged() == want
    judged_odd = fm_decontam.contamination(odd, bench)
    assert judged_odd.count() == len(ROWS) and judged_odd.columns[-1] == "contamination_"
    assert fm_decontam.contamination(none, bench).count() == 0
    assert fm_decontam.contamination(frame, bench.limit(0)).where("contamination.n_hit > 0").count() == 0
    assert fm_decontam.without_contaminated(odd, bench).columns == odd.columns


# SimHash


def plain_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    shingles = [" ".join(words[n : n + 4]) for n in range(max(1, len(words) - 3))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reached, by the fingerprints' links."""
    nodes = sorted(set(prints.values()))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 4:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for doc, fp in sorted(prints.items()):
        least.setdefault(find(fp), doc)
    return {doc: least[find(fp)] for doc, fp in prints.items()}


def test_simhash(spark, sf, documents):
    prints = {r.doc_id: plain_fingerprint(r.text) for r in documents.collect()}
    names = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in q.queries()["op10_pigeon_simhash"](spark, sf).collect()}
    assert got == {d: (f"{fp:016x}", names[d]) for d, fp in prints.items()}
    assert len(set(names.values())) < len(names)


@pytest.mark.parametrize("paired", [128, 8, 3])
def test_links_reach_what_all_pairs_reach(spark, paired):
    from pyspark.sql import functions as F

    from roadpulse.llm.connected import components

    rng = np.random.default_rng(3)
    prints = []
    for _ in range(25):  # chains and clouds around random centres
        at = int(rng.integers(0, 1 << 63)) << 1
        for _ in range(12):
            for bit in rng.choice(64, int(rng.integers(0, 6)), replace=False).tolist():
                at ^= 1 << bit
            prints.append(at)
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    found = {r.node % (1 << 64): r.root for r in components(pigeon_simhash.linked(frame, paired=paired)).collect()}
    names = plain_components(dict(zip(prints, prints, strict=True)))
    groups = defaultdict(set)
    for p in prints:
        groups[found.get(p, ("alone", p))].add(p)
    want = defaultdict(set)
    for p in prints:
        want[names[p]].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert components(frame.select(F.col("fp").alias("a"), F.col("fp").alias("b"))).count() == 0


def test_simhash_odd(spark, odd, none):
    got = pigeon_simhash.near_duplicates(odd).collect()
    assert len(got) == len(ROWS)
    by_text = {(r.doc_id, r.fp): r.component_id for r in got}
    assert by_text[(5, pigeon_simhash.fingerprint(ROWS[4][1]))] == 4
    assert all(r.component_id == 2 for r in got if r.fp == 0)  # null, empty and blank texts
    kept = pigeon_simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["-8", "1", "2", "4", "7", "None", "None"])
    assert pigeon_simhash.near_duplicates(none).count() == 0 and pigeon_simhash.keep_first(none).count() == 0


def test_rows_of_one_id_in_different_components(spark):
    a, b, c = "first of two texts of one id", "another wording that shares nothing", "a third one with quite other words"
    rows = [(7, a, 1), (7, b, 2), (3, c, 3), (7, c, 4), (9, a, 5), (3, c, 6), (8, a.upper(), 7), (8, a, 8), (10, b, 9), (10, "alone", 10)]
    # b and a of id 7 are the least of their groups; its c is linked to 3.
    want = [(3, c, 3), (7, a, 1), (7, b, 2), (10, "alone", 10)]
    for parts in (1, 4):
        frame = spark.createDataFrame(rows, "doc_id long, text string, fp int").repartition(parts, "fp")
        assert sorted(map(tuple, pigeon_simhash.keep_first(frame).collect())) == sorted(want)


# Language


def test_languages(spark, documents, odd, none):
    judged = hyper_lang.languages(documents).select("doc_id", "lang", "text", "language").collect()
    held = [r for r in judged if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.lang == r.language.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.language.score <= 1 for r in judged)
    got = hyper_lang.languages(odd)
    assert got.columns[-1] == "language_" and got.count() == len(ROWS)
    unknown = got.where("text is null or not text rlike '\\\\p{L}'").select("language_.*").collect()
    assert {(r.lang, r.score) for r in unknown} == {("und", 0.0)}
    assert hyper_lang.languages(none).count() == 0
    untaught = hyper_lang.languages(documents.limit(5), held_out=lambda c: c.isNotNull() | c.isNull()).collect()
    assert {r.language.lang for r in untaught} == {"und"}


def test_hypervectors_are_sums_of_bound_letters():
    two, one, plain = hyper_lang._letters()
    codes = hyper_lang.trigrams("Ab c!")
    rows = [(32, 97, 98), (97, 98, 32), (98, 32, 99), (32, 99, 32)]
    assert codes.tolist() == [a << 28 | b << 14 | c for a, b, c in rows]
    want = sum(np.roll(plain[a], 2).astype(int) * np.roll(plain[b], 1) * plain[c] for a, b, c in rows)
    assert (hyper_lang.bundle(codes, np.ones(4)) == want).all()
    assert len(hyper_lang.trigrams("12 !")) == 0 and len(hyper_lang.trigrams(None)) == 0


# Toxicity and quality


def auc(scores, truth):
    good, bad = ([s for s, t in zip(scores, truth, strict=True) if t == k] for k in (1, 0))
    return np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])


def test_toxicity(spark, odd, none):
    words = [f"w{n}" for n in range(400)]
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for n in range(900):
        text = rng.choice(words, 60).tolist()
        if toxic := int(n % 6 == 0):
            for _ in range(3):
                text.insert(int(rng.integers(0, 60)), rng.choice(["vile", "nasty", "horridly", "horridest"]))
        rows.append((n, " ".join(text)))
        labels.append((n, toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = zstd_toxicity.toxicity(frame, marks).select("doc_id", "toxicity.score").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    truth = dict(labels)
    assert auc([r.score for r in held], [truth[r.doc_id] for r in held]) > 0.98
    assert np.mean([(r.score >= 0.7) == truth[r.doc_id] for r in held]) > 0.97
    kept = zstd_toxicity.without_toxic(frame, marks)
    assert kept.columns == frame.columns and 700 < kept.count() < 790

    strange = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (4, None), (5, 7), (3, 0)], "doc_id long, toxic int")
    for teach in (strange, strange.limit(0), marks):
        scored = zstd_toxicity.toxicity(odd, teach)
        assert scored.columns[-1] == "toxicity_"
        assert all(0 <= r[0] <= 1 for r in scored.select("toxicity_.score").collect()) and scored.count() == len(ROWS)
        assert zstd_toxicity.toxicity(none, teach).count() == 0


def test_quality(spark, odd, none):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    rows, labels = [], []
    for n in range(1200):
        good = int(rng.random() < (0.9 if n % 10 < 7 else 0.2))
        text = " ".join(rng.choice(["some", "good", "words", "here"], 40)) if good else "BAD!! " * int(rng.integers(20, 60))
        rows.append((n, text, f"h{n % 10}", f"p{n % 3}"))
        labels.append((n, good))
    frame = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality_bayes.quality(frame, marks, F.col("host"), F.col("path")).collect()
    truth = dict(labels)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.keep == truth[r.doc_id] for r in held]) > 0.97
    low = np.mean([r.host_posterior for r in got if int(r.host[1:]) >= 7])
    high = np.mean([r.host_posterior for r in got if int(r.host[1:]) < 7])
    assert low < 0.4 < 0.7 < high
    # A sparse site stays near the mean of all.
    few = spark.createDataFrame([(5000, rows[0][1], "new", "p"), (5001, None, None, None)], frame.schema)
    both = {r.doc_id: r for r in quality_bayes.quality(frame.unionByName(few), marks, F.col("host"), F.col("path")).collect()}
    mean = np.mean([r.doc_score for r in got])
    assert abs(both[5000].host_posterior - mean) < 0.05 and 0 <= both[5001].score <= 1
    strange = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (4, None)], "doc_id long, quality int")
    for teach in (strange, strange.limit(0)):
        assert quality_bayes.quality(odd, teach, F.col("source"), F.col("lang")).count() == len(ROWS)
        assert quality_bayes.quality(none, teach, F.col("source"), F.col("lang")).count() == 0


def test_full_keys_are_split_before_points_are_used(spark):
    """Fingerprints that agree in the boxes of a key only: the longer keys tell them apart."""
    rng = np.random.default_rng(4)
    same = (1 << 30) - 1
    prints = {int(x) & ~same & ((1 << 63) - 1) for x in rng.integers(0, 1 << 63, 300)}
    near = {p ^ 1 << 40 ^ 1 << 50 for p in list(prints)[:40]}
    frame = spark.createDataFrame([(p,) for p in sorted(prints | near)], "fp long")
    links = pigeon_simhash.linked(frame, paired=128)
    assert "point" not in links._jdf.queryExecution().analyzed().toString()
    got = {tuple(sorted(r)) for r in links.collect()}
    both = sorted(prints | near)
    assert got == {(a, b) for n, a in enumerate(both) for b in both[n + 1 :] if (a ^ b).bit_count() <= 4} and len(got) >= 40
    with pytest.raises(ValueError):
        pigeon_simhash.linked(frame.limit(0), most=6)


def test_plan_of_links_stays_small(spark):
    """The driver holds the plan again for every step of a query: keys and chains are no expression each."""
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre ^ 1 << int(i) ^ 1 << int(j) for i, j in rng.integers(0, 62, (300, 2))}
    links = pigeon_simhash.linked(spark.createDataFrame([(p,) for p in sorted(prints)], "fp long"), paired=8)
    plan = links._jdf.queryExecution().optimizedPlan().toString()
    assert "point" in plan and len(plan) < 30_000


def near_copies(size):
    """Fingerprints within three bits of one, out of 16 bits: not all of them are linked to each other."""
    rng = np.random.default_rng(6)
    bits, found = rng.choice(64, 16, replace=False), {0}
    while len(found) < size:
        found.add(sum(1 << int(b) for b in rng.choice(bits, int(rng.integers(1, 4)), replace=False)))
    return sorted(x - (1 << 64) if x >> 63 else x for x in found)


def test_links_of_near_copies_grow_with_the_group(spark):
    """No key is full here, so all links come from pairs: a group twice as large gave four times the links."""
    from roadpulse.llm.connected import components

    rows = []
    for size in (60, 120):
        prints = near_copies(size)
        links = pigeon_simhash.linked(spark.createDataFrame([(p,) for p in prints], "fp long"))
        assert "point" not in links._jdf.queryExecution().analyzed().toString()
        rows.append(links.count())
        names = plain_components({p: p % (1 << 64) for p in prints})
        found = {r.node: r.root for r in components(links).collect()}
        assert {p: found.get(p, p) for p in prints} == names
        assert all(((r.a ^ r.b) % (1 << 64)).bit_count() <= 4 for r in links.collect())
    assert rows[1] < 3 * rows[0]


def test_quality_of_repeated_ids_is_the_same_again(spark):
    """Rows of one id with different texts: one of them teaches, whatever the order of the rows."""
    from pyspark.sql import functions as F

    rows = [(n, text, "h", "p") for n in range(60) for text in (f"a calm line of words {n}", "LOUD!!! " * (n + 1))]
    marks = spark.createDataFrame([(n, n % 2) for n in range(60)], "doc_id long, quality int")
    results = []
    for given in (rows, rows[::-1]):
        frame = spark.createDataFrame(given, "doc_id long, text string, host string, path string").repartition(3)
        results.append(sorted((r.doc_id, round(r.doc_score, 12)) for r in quality_bayes.quality(frame, marks, F.col("host"), F.col("path")).collect()))
    assert results[0] == results[1] and len(results[0]) == len(rows)


def _strength(sites):
    """Brute force of the prior strength: sites of (n, sum, sum of squares, prior)."""
    many = [s for s in sites if s[0] > 1]
    spread = np.mean([(k / n - prior) ** 2 for n, k, _, prior in many])
    noise = np.mean([(sq / n - (k / n) ** 2) / (n - 1) for n, k, sq, _ in many])
    whole = np.mean([prior * (1 - prior) for *_, prior in many])
    return float(np.clip(whole / max(spread - noise, 1e-9) - 1, quality_bayes.LEAST_STRENGTH, quality_bayes.MOST_STRENGTH))


def test_registered_quality_against_brute_force(spark, sf, documents):
    found = q.queries()["op2_quality_bayes"](spark, sf).collect()
    docs = {r.doc_id: r for r in documents.collect()}
    assert {(r.doc_id, r.host, r.path) for r in found} == {(d, r.source, r.lang) for d, r in docs.items()} and len(found) == len(docs)
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in found:
        hosts[r.host].append(r.doc_score)
        paths[r.host, r.path].append(r.doc_score)
    total = lambda ps: (len(ps), sum(ps), sum(p * p for p in ps))
    mean = sum(r.doc_score for r in found) / len(found)
    host_strength = _strength([(*total(ps), mean) for ps in hosts.values()])
    prior = {h: (sum(ps) + host_strength * mean) / (len(ps) + host_strength) for h, ps in hosts.items()}
    path_strength = _strength([(*total(ps), prior[h]) for (h, _), ps in paths.items()])
    logit = lambda p: np.log(min(max(p, 1e-6), 1 - 1e-6)) - np.log(1 - min(max(p, 1e-6), 1 - 1e-6))
    for r in found:
        of_host, of_path = hosts[r.host], paths[r.host, r.path]
        host = (sum(of_host) - r.doc_score + host_strength * mean) / (len(of_host) - 1 + host_strength)
        path = (sum(of_path) - r.doc_score + path_strength * host) / (len(of_path) - 1 + path_strength)
        score = 1 / (1 + np.exp(-(logit(r.doc_score) + logit(path) - logit(mean))))
        assert np.allclose([r.host_posterior, r.path_posterior, r.score], [host, path, score], rtol=1e-6, atol=1e-9)
        assert r.predicted == int(r.score >= quality_bayes.KEPT_FROM)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_registered_language_and_toxicity_columns(spark, sf, documents):
    docs = {r.doc_id: r for r in documents.collect()}
    langs = {r.lang for r in docs.values()} - {None}
    found = q.queries()["op7_hyper_lang"](spark, sf)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = found.collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert r.lang_pred in langs if letters else r.lang_pred == "und"
    held = [r for r in got if r.held_out and docs[r.doc_id].lang]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.9
    found = q.queries()["op9_zstd_toxicity"](spark, sf)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    got = found.collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.7)
