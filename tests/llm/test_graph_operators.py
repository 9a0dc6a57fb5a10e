"""Tokenizer alignment, link filter and prefix trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest

from roadpulse.llm import link_filter, prefix_trie, token_alignment
from roadpulse.llm import queries as q
from tests.llm.conftest import LONG, ROWS

# Alignment


def plain_groups(text, v):
    """Groups of one text as [(A ids, B ids)] and its links, or None without tokens."""
    if not text:
        return None
    a, b = v.a.encode(" " + text, add_special_tokens=False).ids, v.b.encode(text)
    want = b" " + text.encode()
    if b"".join(v.bytes_a[n] for n in a) != want or b"".join(v.bytes_b[n] for n in b) != want:
        return None
    ends_a, ends_b = (list(accumulate(len(x[n]) for n in ids)) for x, ids in ((v.bytes_a, a), (v.bytes_b, b)))
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        own_a, own_b, first_i, first_j = [], [], i, j
        while i < len(a) and ends_a[i] <= end:
            own_a.append(a[i])
            i += 1
        while j < len(b) and ends_b[j] <= end:
            own_b.append(b[j])
            j += 1
        groups.append((own_a, own_b))
        for x in range(first_i, i):
            for y in range(first_j, j):
                if max(ends_a[x - 1] if x else 0, ends_b[y - 1] if y else 0) < min(ends_a[x], ends_b[y]):
                    links.append((a[x], b[y]))
    return len(a), len(b), groups, links


def plain_alignment(rows, v):
    found = [(d, plain_groups(t, v)) for d, t in rows]
    pairs = Counter(link for _, g in found if g for link in g[3])
    best = Counter()
    for (_, b), n in pairs.items():
        best[b] = max(best[b], n)
    out = []
    for d, g in found:
        if g is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g[2])
        out.append((d, g[0], g[1], len(g[2]), len(g[3]), sum(pairs[x] == best[x[1]] for x in g[3]), sum(pairs[x] for x in g[3]), text))
    return out, pairs, best


@pytest.fixture(scope="module")
def vocabularies():
    return token_alignment.Vocabularies(q.byte_bpe(), q.piece_bpe())


def by_text(rows):
    return sorted(rows, key=str)


def test_alignment_of_the_whole_table(spark, sf, documents, vocabularies):
    want, _, _ = plain_alignment([(r.doc_id, r.text) for r in documents.collect()], vocabularies)
    want = [(*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want]
    got = q.queries()["op11_token_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert by_text(map(tuple, got.collect())) == by_text(want)


ODD_TEXTS = [
    "▁ the mark of a space", "a  b   c \n d", " first and last ", "\n\ttabs\t\n", "<s> </s> <unk> <0x0A> <|endoftext|>", "x\u00a0y\u3000z \u2028 w",
    "nul \x00 and \x1c\x1d separators \x85 next", "漢字かな交じり文 😀😀 🇫🇷", "don't can't we'll I'M", "e\u0301 combining \u200d joiner", "1234567890 12,345.67", "a" * 3000,
]


def test_alignment_of_odd_rows(spark, odd, none, vocabularies):
    rows = [(r[0], r[1]) for r in ROWS] + [(100 + n, t) for n, t in enumerate(ODD_TEXTS)] + [(200 + n, "the same the same") for n in range(40)]
    want, pairs, best = plain_alignment(rows, vocabularies)
    extra = spark.createDataFrame([(i, t) for i, t in rows if (i or 0) >= 100], "doc_id long, text string")
    docs = odd.select("doc_id", "text", "kept", "key").unionByName(extra, allowMissingColumns=True).repartition(5)
    got = token_alignment.alignments(docs, q.byte_bpe(), q.piece_bpe())
    assert by_text(map(tuple, got.collect())) == by_text(want)
    table = {(r.a, r.b): (r.n, r.best) for r in token_alignment.pair_table(docs, q.byte_bpe(), q.piece_bpe()).collect()}
    assert table == {k: (n, n == best[k[1]]) for k, n in pairs.items()}
    assert token_alignment.alignments(none, q.byte_bpe(), q.piece_bpe()).count() == 0


def test_alignment_forgets_and_learns_again(monkeypatch, vocabularies):
    monkeypatch.setattr(token_alignment, "REMEMBERED", 30)
    aligner = token_alignment.Aligner(vocabularies)
    texts = [t for t in ODD_TEXTS if t] + [f"word{n} and word{n + 1}, more." for n in range(60)]
    for start in range(0, len(texts), 7):
        part = texts[start : start + 7]
        counts, groups, _, _ = aligner(part)
        for text, own, found in zip(part, counts.tolist(), groups, strict=True):
            plain = plain_groups(text, vocabularies)
            assert own == ([plain[0], plain[1], len(plain[2]), len(plain[3])] if plain else [0, 0, 0, 0])
            assert found == (";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain[2]) if plain else "")


def test_alignment_of_a_text_larger_than_a_slice(spark, vocabularies):
    text = LONG * (1 + (token_alignment.SLICE_BYTES + (1 << 20)) // len(LONG))
    docs = spark.createDataFrame([(1, text), (2, "lorem ipsum")], "doc_id long, text string")
    got = {r.doc_id: r for r in token_alignment.alignments(docs, q.byte_bpe(), q.piece_bpe(), digest=True).collect()}
    ids = [len(vocabularies.a.encode(" " + text, add_special_tokens=False).ids), len(vocabularies.b.encode(text))]
    assert [got[1].n_a, got[1].n_b] == ids and got[1].n_links == sum(ids) - got[1].n_groups and got[2].n_a > 0


# Link filter


def plain_host(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host):])[0]


def plain_verdicts(pages, rules, damping=0.85, share=0.5, rounds=200):
    """pages: (page_id, url, hosts linked). Sums the walks of trust and distrust."""
    named = []
    for p, url, hosts in pages:
        host, path = plain_host(url)
        fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        named.append((p, host, path, max(fits, key=lambda r: len(r[0] + r[1])) if fits else None, hosts))
    links, pages_of = Counter(), defaultdict(list)
    for _, host, _, rule, hosts in named:
        if host:
            pages_of[host].append(rule and rule[2])
            for h in set(hosts) - {"", host}:
                links[host, h] += 1
    scores = {}
    for kind, verdict, steps in (("trust", "allow", links), ("distrust", "block", {(b, a): n for (a, b), n in links.items()})):
        mass = {h: (1 - damping) * sum(v == verdict for v in own) / len(own) for h, own in pages_of.items()}
        out, total = Counter(), Counter()
        for (a, _), n in steps.items():
            out[a] += n
        for _ in range(rounds):
            total.update(mass)
            new = Counter()
            for (a, b), n in steps.items():
                new[b] += damping * mass.get(a, 0.0) * n / out[a]
            mass = new
        scores[kind] = total
    return sorted((p, host, path, rule and rule[0] + rule[1], rule[2] if rule else (
        "block" if host and scores["distrust"][host] - scores["trust"][host] >= share * (1 - damping) - 1e-9 else "allow"))
        for p, host, path, rule, _ in named)


def links_html(hosts):
    return "<p>text</p>" + "".join(f'<li><A class="x" HREF="{"http:" if n % 2 else ""}//{h.upper()}/a?b#c">{h}</a>' for n, h in enumerate(hosts)) + '<a href="/own">x</a>'


def test_link_filter_spreads_over_links(spark):
    rng = random.Random(3)
    hosts = [f"h{n}.example.{'com' if n % 4 else 'net'}" for n in range(40)] + ["good.example.org", "far.test"]
    pages = []
    for n in range(900):
        host = "h1.example.com" if n % 3 == 0 else rng.choice(hosts)  # a third of all pages on one host
        path = rng.choice(["/de/", "/en/", "/fr/"]) + str(n) if host != "far.test" else ""
        pages.append((n, f"https://{host}{path}?q=://x#y", rng.sample(hosts, rng.randrange(4))))
    frame = spark.createDataFrame([(p, u, links_html(h)) for p, u, h in pages], "page_id long, url string, html string")
    for rules in (link_filter.RULES, (("net", "/", "block"), ("h1.example.com", "/", "block"), ("good.example.org", "/", "allow"))):
        for share in (0.5, 0.2):
            got = link_filter.judge(frame, rules, blocked_share=share)
            want = plain_verdicts(pages, rules, share=share)
            rows = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect())
            assert rows == want
            assert len({w[4] for w in want if w[3] is None}) == 2 or share == 0.5


def test_link_filter_scores(spark):
    seeds = spark.createDataFrame([("a", 1.0, 0.0), ("z", 0.0, 1.0)], "host string, trusted double, blocked double")
    links = spark.createDataFrame([("a", "b", 3), ("a", "c", 1), ("b", "z", 5), ("y", "z", 5)], "source string, target string, n long")
    got = {r.host: (round(r.trust, 6), round(r.distrust, 6)) for r in link_filter.propagate(seeds, links).collect()}
    d = 0.85
    assert got == {"a": (0.15, round(0.15 * d * d / 2, 6)), "b": (round(0.15 * d * 0.75, 6), round(0.15 * d / 2, 6)), "c": (round(0.15 * d * 0.25, 6), 0.0),
                   "z": (round(0.15 * d * d * 0.75, 6), 0.15), "y": (0.0, round(0.15 * d / 2, 6))}


def test_link_filter_odd_rows(spark):
    urls = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.NET/en/x", "http://net", "http://net/", "ftp://a.net?x", "http://xnet/", "http://example.com/de/",
            "http://a.example.com/DE/", "http://b.org/fr/?#", "http://Ünet.ORG/fr", "http://example.net:80/en/", "http://a.net/b://c.net/d"]
    rows = [(n, u, None if n % 2 else "") for n, u in enumerate(urls)] + [(None, "http://a.net/", "<a href=//b.net>"), (0, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS by", "3 AS trust", "4 AS hosts")
    got = link_filter.judge(frame).collect()
    want = plain_verdicts([(-1 if p is None else p, u, ["b.net"] if p is None else []) for p, u, _ in rows], link_filter.RULES)
    assert sorted((-1 if r.page_id is None else r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == want
    by_id = {r.page_id: r for r in got if r.page_id not in (None, 0)}
    assert [by_id[n].rule for n in range(1, 16)] == [
        None, None, None, None, "example.net/en/", None, "net/", None, None, "example.com/de/", None, "org/fr/", None, None, "net/"]
    assert by_id[6].verdict == "block" and by_id[8].verdict == "block" and by_id[4].verdict == "allow"
    assert link_filter.judge(frame.where("page_id = 99")).count() == 0
    long_page = spark.createDataFrame([(1, "http://a.test/", "<p>" + "x < y " * 2_000_000 + '<a href="http://b.net/">b</a>')], "page_id long, url string, html string")
    assert link_filter.judge(long_page).first().verdict == "allow"


# Prefix trie


def plain_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    def mark(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, mark(role or "", text or ""), role or "", text or ""))
    convs = {c: [(r, t) for _, _, _, r, t in sorted(own)] for c, own in convs.items()}
    nodes = defaultdict(lambda: [[], []])  # members, ends
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made = convs.get(first, [])[:h] + own[h:]
        for d in range(len(made) + 1):
            nodes[tuple(made[:d])][0].append(c)
        nodes[tuple(made)][1].append(c)
    children, sums = Counter(n[:-1] for n in nodes if n), defaultdict(lambda: [0, 0])
    for n in sorted(nodes, key=len, reverse=True):
        own = sums[n]
        own[0] += n not in children
        own[1] += (len(nodes[n][0]) - 1) * len(n[-1][1].encode()) if n else 0
        if n:
            sums[n[:-1]][0] += own[0]
            sums[n[:-1]][1] += own[1]
    return sorted((min(m), len(n), min(nodes[n[:-1]][0]) if n else None, len(m), children[n], *sums[n],
                   hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest()) for n, (m, e) in nodes.items())


TURN = "conv_id long, turn long, role string, text string"


def trie_rows(frame):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                  for r in prefix_trie.prefix_trie(frame).collect())


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), 230):
        for turn in range(rng.randrange(1, 14)):
            # Few texts, so that prefixes are shared; a third of all conversations are one and the same.
            text = f"t{turn}" if c % 3 == 0 else rng.choice(["", "hé", "ho", "a longer text"])
            rows.append((c, turn, ["user", "assistant"][turn % 2], text))
    rows += [(1000, n, "user", f"deep {n % 7}") for n in range(700)]  # one chain of very many turns
    rows += [(1001, n, "user", f"deep {n % 7}") for n in range(400)]
    rows += [(2000, None, None, None), (2000, None, "user", "x"), (2000, 3, None, "y"), (2000, 3, "user", None), (2000, 3, "user", None)]
    rows += [(None, 1, "user", "nobody's"), (2003, 0, "user", ""), (2004, 0, "", "user"), (-3, 1, "user", "x" * 100_000)]
    return rows


@pytest.mark.parametrize("parts", [1, 8])
def test_prefix_trie(spark, parts):
    rows = conversations(parts)
    frame = spark.createDataFrame(rows, TURN).selectExpr("*", "1 AS depth", "2 AS high", "3 AS n_convs").repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13" if parts > 1 else before)
        assert trie_rows(frame) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_prefix_trie_of_nothing(spark):
    none = spark.createDataFrame([], TURN)
    assert prefix_trie.prefix_trie(none).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], TURN)).count() == 0
    one = [(7, None, None, None)]
    assert trie_rows(spark.createDataFrame(one, TURN)) == plain_trie(one)


def test_contraction_of_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(prefix_trie, "stored", lambda df, label, keep=prefix_trie.stored: (written.append(label), keep(df, label))[1])
    n = 600
    chain = [(0, d, 0 if d else None, d - 1 if d else None, int(d < n - 1), int(d == n - 1), d) for d in range(n)]
    tree = spark.createDataFrame(chain, "conv_id long, depth long, up_conv_id long, up_depth long, n_children long, n_leaves long, saved long")
    got = {r.depth: (r.n_leaves, r.saved) for r in prefix_trie.subtree_totals(tree).collect()}
    assert got == {d: (1, sum(range(d, n))) for d in range(n)}
    assert written.count("compressed") < 40


def test_ends_that_reach_over_several_tasks(spark, monkeypatch):
    rows = [(1, 2, c) for c in range(4000)] + [(1, 3, 5), (0, 9, 8), (0, 9, 7)] + [(n, n, n) for n in range(10, 500)]
    frame = spark.createDataFrame(rows, "high long, low long, conv_id long").repartition(6)
    got = {(r.high, r.low): r.ends_sha256 for r in prefix_trie.ends_digests(frame).collect()}
    want = defaultdict(list)
    for h, low, c in rows:
        want[h, low].append(c)
    assert got == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in want.items()}
