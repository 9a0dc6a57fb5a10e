"""Quality by hierarchical empirical Bayes.

A classifier gives each document a probability from its text alone. Sums of these over sites make
beta posteriors on two levels: a host is shrunk toward the global mean, a path toward its host,
each by a strength that the spread between sites fixes. A document's score joins its own evidence
with the posterior of its path, its own share left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import hashed_below, in_slices, stored

# The classifier is fitted on so many labelled documents at most, chosen by a hash of their ids.
SAMPLE = 20_000
BINS = 12
RIDGE = 0.002
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6
KEPT_FROM = 0.5
SLICE_BYTES = 8 << 20
FEATURES = 9


def features(text: str | None) -> list[float]:
    """Shape of a whole text: sizes, and shares of capitals, marks, digits, repeats and the like."""
    data = (text or "").encode()
    raw = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    capitals, small = int(raw[65:91].sum()), int(raw[97:123].sum())
    marks = int(raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum())
    lines = data.split(b"\n")
    return [
        float(np.log1p(len(words))), capitals / max(1, capitals + small), marks / size, int(raw[48:58].sum()) / size,
        len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(data) / n, len(set(lines)) / len(lines), int(raw[124] + raw[38] + raw[36] + raw[35] + raw[42] + raw[33]) / n,
    ]


def _described(docs: DataFrame) -> DataFrame:
    """doc_id, host, path and the features; the text is read once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE_BYTES):
            found = pa.array([features(t) for t in part["text"].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part["doc_id"], part["host"], part["path"], found], names=["doc_id", "host", "path", "x"])

    return docs.mapInArrow(run, "doc_id long, host string, path string, x array<double>")


class Classifier:
    """Logistic regression over equally filled bins of each feature."""

    def __init__(self, x: np.ndarray, good: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(FEATURES)] if len(x) else []
        share = float(np.clip(good.mean(), 1e-4, 1 - 1e-4)) if len(good) else 0.5
        self.weights = np.zeros(1 + FEATURES * BINS)
        self.weights[0] = np.log(share / (1 - share))
        if len(good) == 0 or good.min() == good.max():
            return
        coded = self._coded(x)
        ridge = np.full(len(self.weights), RIDGE)
        ridge[0] = 1e-8
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(coded @ self.weights, -30, 30)))
            step = np.linalg.solve((coded.T * (p * (1 - p))) @ coded / len(x) + np.diag(ridge),
                                   coded.T @ (good - p) / len(x) - ridge * self.weights)
            self.weights += step
            if np.abs(step).max() < 1e-8:
                break

    def _coded(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), 1 + FEATURES * BINS))
        out[:, 0] = 1
        for k, edges in enumerate(self.edges):
            out[np.arange(len(x)), 1 + k * BINS + np.searchsorted(edges, x[:, k], side="right")] = 1
        return out

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._coded(x) @ self.weights, -12, 12)))


def _judged(described: DataFrame, model: Classifier) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                x = part["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["host"], part["path"], pa.array(model(x))],
                                                 names=["doc_id", "host", "path", "p"])

    return described.mapInArrow(run, "doc_id long, host string, path string, p double")


def _strength(sites: DataFrame, prior: Column) -> float:
    """Pseudo-documents of a beta prior, by moments: the spread of site means around their prior
    beyond what the documents inside a site explain."""
    mean = F.col("k") / F.col("n")
    row = sites.where("n > 1").agg(
        F.avg((mean - prior) * (mean - prior)).alias("spread"), F.avg((F.col("s") / F.col("n") - mean * mean) / (F.col("n") - 1)).alias("noise"),
        F.avg(prior * (1 - prior)).alias("whole")).first()
    if row.spread is None:
        return MOST_STRENGTH
    between = max(row.spread - row.noise, 1e-9)
    return float(np.clip(row.whole / between - 1, LEAST_STRENGTH, MOST_STRENGTH))


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(inside / (1 - inside))


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, held_out=lambda doc_id: hashed_below(doc_id, 3, 1)) -> DataFrame:
    """doc_id, host, path, doc_score, host_posterior, path_posterior, score and keep.

    ``docs`` has doc_id and text; ``labels`` has doc_id and quality (0 or 1, anything else teaches
    nothing). Labels of ids for which ``held_out`` is true are not used. Null hosts and paths are
    sites of their own. Null and empty texts are scored by the features of an empty text. A site of
    one document says nothing beyond its parent. Without labels doc_score is 0.5. Repeated rows
    count as often as they occur; of rows that share an id and differ in their text, the one with the
    least features teaches, all are scored. Texts of any length are read whole, one at a time. Other
    columns of ``docs`` and ``labels``, whatever their names, play no part. Sites of any size are pre-aggregated; the texts are not shuffled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       host.cast("string").alias("host"), path.cast("string").alias("path"))
    described = stored(_described(rows), "quality-features")
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # Of several rows of an id the least features teach, so that a rerun fits the same model.
    sample = described.join(F.broadcast(usable), "doc_id").groupBy("doc_id").agg(
        F.min("x").alias("x"), F.max("quality").alias("quality")).orderBy("doc_id").collect()
    model = Classifier(np.array([r.x for r in sample], float).reshape(-1, FEATURES), np.array([r.quality for r in sample], float))
    judged = stored(_judged(described, model), "quality-evidence")

    paths = stored(judged.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum("p").alias("k"), F.sum(F.col("p") * F.col("p")).alias("s")), "quality-sites")
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum("s").alias("s")), "quality-sites")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    mean = total.k / total.n if total.n else 0.5
    host_strength = _strength(hosts, F.lit(mean))
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("k").alias("host_k"))
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    sites = stored(sites.withColumn("prior", (F.col("host_k") + host_strength * mean) / (F.col("host_n") + host_strength)), "quality-sites")
    path_strength = _strength(sites, F.col("prior"))
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "k", "host_n", "host_k")

    p = F.col("p")
    own_host = (F.col("host_k") - p + host_strength * mean) / (F.col("host_n") - 1 + host_strength)
    own_path = (F.col("k") - p + path_strength * F.col("host_posterior")) / (F.col("n") - 1 + path_strength)
    joined = judged.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    scored = joined.withColumn("host_posterior", own_host).withColumn("path_posterior", own_path).withColumn(
        "score", 1 / (1 + F.exp(-(_logit(p) + _logit(F.col("path_posterior")) - _logit(F.lit(mean))))))
    return scored.select("doc_id", "host", "path", p.alias("doc_score"), "host_posterior", "path_posterior", "score",
                         (F.col("score") >= KEPT_FROM).alias("keep"))
