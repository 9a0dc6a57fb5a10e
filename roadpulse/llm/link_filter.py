"""URL filters: rules by host and path, and propagation over the links between hosts for the rest.

DataFrame functions only. Trust spreads from hosts whose pages the rules allow along links, as a
personalised PageRank; distrust spreads from hosts whose pages the rules block against the links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

DAMPING = 0.85
# Rounds end when less than this share of a seed is still on its way.
TOLERANCE = 1e-3
# A host is blocked when its distrust exceeds its trust by what a host gets whose pages are to this
# share on blocked seeds, without any link.
BLOCKED_SHARE = 0.5
# (host, path, verdict); a rule covers its host and all hosts below it.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<a\s[^>]*?\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if none."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest rule (host and path together, then host) that covers a URL, as a struct of
    ``rule`` and ``verdict``; null if none does. Of two rules alike the blocking one holds."""
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block"))
    cases = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for own, prefix, verdict in longest:
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(prefix)
        cases = cases.when(fits, F.struct(F.lit(own + prefix).alias("rule"), F.lit(verdict).alias("verdict")))
    return cases


def linked_hosts(html: Column) -> Column:
    """The distinct hosts that the anchors of a page name; links without a host stay on their own."""
    urls = F.regexp_extract_all(html, F.lit(_LINK), F.lit(1))
    hosts = F.transform(urls, lambda u: F.translate(F.regexp_extract(u, r"//([^/?#]*)", 1), _UPPER, _LOWER))
    return F.array_distinct(F.coalesce(hosts, F.array().cast("array<string>")))


def host_links(pages: DataFrame) -> DataFrame:
    """source, target, n: how many pages (host, hosts) of one host name another. Counted before the
    shuffle, so a host with very many pages sends each of its targets once per task."""
    named = pages.where("host != ''").select(F.col("host").alias("source"), F.explode("hosts").alias("target"))
    return named.where("target != '' AND source != target").groupBy("source", "target").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust of every host that anything reaches.

    ``seeds``: host, trusted and blocked, each 0 to 1. Trust moves from source to target, in shares
    of the links that leave the source; distrust from target to source, in shares of the links that
    arrive at the target. Each round moves ``damping`` times what the last round brought, so the
    sums approach the personalised PageRank without its restart of what reaches a dead end, which
    would only scale every host alike. Ends when ``tolerance`` of the seeds is left; each round is
    a written table of at most two rows per host."""
    steps = stored(_shares(links, "source", "target", "trust").unionByName(_shares(links, "target", "source", "distrust")), "host-steps")
    first = seeds.select("host", F.stack(F.lit(2), F.lit("trust"), "trusted", F.lit("distrust"), "blocked").alias("kind", "mass"))
    rounds = [stored(first.where("mass > 0").withColumn("mass", F.col("mass") * (1 - damping)), "host-mass")]
    limit = None
    while True:
        left = rounds[-1].agg(F.sum("mass")).first()[0] or 0.0
        limit = left * tolerance if limit is None else limit
        if left <= limit:
            break
        moved = rounds[-1].join(steps, (F.col("host") == F.col("at")) & (F.col("kind") == F.col("of")))
        rounds.append(stored(moved.groupBy(F.col("to").alias("host"), "kind").agg(
            F.sum(F.col("mass") * F.col("share") * damping).alias("mass")), "host-mass"))
    everything = reduce(DataFrame.unionByName, [r.select("host", "kind", "mass") for r in rounds])
    total = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    return everything.groupBy("host").agg(*total)


def _shares(links: DataFrame, start: str, end: str, kind: str) -> DataFrame:
    """at, to, of, share: the part of what ``start`` has that one link takes to ``end``."""
    out = links.groupBy(F.col(start).alias("from")).agg(F.sum("n").alias("all"))
    return links.join(out, F.col(start) == F.col("from")).select(
        F.col(start).alias("at"), F.col(end).alias("to"), F.lit(kind).alias("of"), (F.col("n") / F.col("all")).alias("share"))


def judge(
    pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, damping: float = DAMPING,
    tolerance: float = TOLERANCE, blocked_share: float = BLOCKED_SHARE,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, trust, distrust (of its host) and verdict.

    Where a rule covers the URL its verdict holds; else the page is blocked if its host's distrust
    exceeds its trust by ``blocked_share * (1 - damping)`` or more. A host is a seed to the share of
    its pages that rules allow or block. A null URL, or one without ``://``, has an empty host and
    path, no rule, takes no part in the graph and is allowed; an empty host likewise. A null or
    empty html has no links; a very long one is searched whole, by one task. Repeated rows and ids
    each give a row and count as pages of their own. Ties between rules go to the longer host, then
    to the blocking rule. No pages give no rows; other columns are not looked at.

    Pages are read once. Hosts and links are counted before they are shuffled; the join back to
    pages has one row per host on the other side, so a host with a third of all pages can be split."""
    known = stored(pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        rule_of(host_of(F.col("url")), path_of(F.col("url")), rules).alias("by"), linked_hosts(F.col("html")).alias("hosts"),
    ), "pages")
    share = [F.avg(F.when(F.col("by.verdict") == v, 1.0).otherwise(0.0)).alias(name) for v, name in (("allow", "trusted"), ("block", "blocked"))]
    seeds = known.where("host != ''").groupBy("host").agg(*share)
    scores = stored(propagate(seeds, host_links(known), damping, tolerance).withColumnRenamed("host", "of"), "host-scores")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    # A small margin keeps a host that is just at the edge on one side, however sums were rounded.
    bad = distrust - trust >= blocked_share * (1 - damping) - 1e-9
    joined = known.where("host != ''").join(scores, F.col("host") == F.col("of"), "left")
    bare = known.where("host = ''").withColumns({"trust": F.lit(0.0), "distrust": F.lit(0.0)})
    everything = joined.select("page_id", "host", "path", "by", trust.alias("trust"), distrust.alias("distrust")).unionByName(
        bare.select("page_id", "host", "path", "by", "trust", "distrust"))
    return everything.select(
        "page_id", "host", "path", F.col("by.rule").alias("rule"), "trust", "distrust",
        F.coalesce("by.verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"))
