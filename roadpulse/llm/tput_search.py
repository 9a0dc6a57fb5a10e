"""Exact top-k inner-product search with a three-phase uniform threshold.

A vector is cut into ``lists`` runs of dimensions; the score is the sum of one partial score per
run. Phase 1: every task gathers, per query and list, its best entries by partial score, resolves
them, and the k-th best score over all tasks is the safe cutoff. Phase 2: the cutoff goes to all
tasks; an entry can reach it only if at least one of its partial scores reaches cutoff / lists, so
each list gives all its entries from there on. Phase 3: the remaining partial scores of those
entries are added exactly, and the k best of each query stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

LISTS = 2
QUERIES_PER_BLOCK = 2048  # a block's vectors and cutoffs are broadcast: at most so many rows
CELLS = 1 << 20  # scores that a task holds at a time
SCALE = 256
_RESULT = "query_id long, vec_id long, score long"


def scaled(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id and v: floor(256 * x) of every component x as double. Vectors that are null, have no
    component, or hold a null or non-finite component take no part; so do null ids."""
    x = F.col(vector_column).cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x")).where(
        F.col("vec_id").isNotNull() & (F.size("x") > 0) & whole
    ).select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: in floating point only while no sum can pass 2 ** 53."""
    if a.size and b.size and int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a @ b.T


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of k largest values per row, in any order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (scores.shape[0], 1))
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, -k:]


def _searched(k: int, queries: np.ndarray, own_ids: np.ndarray, cutoff: np.ndarray | None, lists: int):
    """The function of phase 1 (no cutoff) or of phases 2 and 3 for one task."""
    width = queries.shape[1]
    runs = np.array_split(np.arange(width), min(lists, width))

    def block(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        partial = [_product(queries[:, r], vectors[:, r]) for r in runs]
        own = own_ids[:, None] == ids[None, :]
        if cutoff is None:
            for p in partial:
                p[own] = np.iinfo(np.int64).min if p.dtype == np.int64 else -np.inf
            columns = np.concatenate([_best(p, min(k, len(ids))) for p in partial], axis=1)
            rows = np.repeat(np.arange(len(queries)), columns.shape[1])
            columns = columns.ravel()
        else:
            # partial >= cutoff / lists, in whole numbers.
            rows, columns = np.nonzero(np.logical_or.reduce([p * len(runs) >= cutoff[:, None] for p in partial]) & ~own)
        keep = ids[columns] != own_ids[rows]
        rows, columns = rows[keep], columns[keep]
        pairs = np.unique(rows * len(ids) + columns)
        rows, columns = pairs // len(ids), pairs % len(ids)
        score = np.zeros(len(rows), np.int64)
        for r in runs:
            for at in range(0, len(rows), 65536):
                s = slice(at, at + 65536)
                score[s] += (queries[rows[s]][:, r] * vectors[columns[s]][:, r]).sum(axis=1)
        if cutoff is not None:
            keep = score >= cutoff[rows]
            rows, columns, score = rows[keep], columns[keep], score[keep]
        return rows, ids[columns], score

    def trimmed(rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best per query, ties to the smaller id."""
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        return rows[rank < k], ids[rank < k], score[rank < k]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = (np.empty(0, np.int64),) * 3
        for batch in batches:
            step = max(1, CELLS // max(1, len(queries)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                found = block(part["vec_id"].to_numpy(), _matrix(part["v"], width))
                best = trimmed(*(np.concatenate(pair) for pair in zip(best, found, strict=True)))
        rows, ids, score = best
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [pa.array(own_ids[rows]), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])

    return task


def _once(vectors: DataFrame) -> tuple[DataFrame, bool]:
    """Without repeats of a whole row, and whether ids still repeat. Only the ids are shuffled unless some do."""
    if vectors.groupBy("vec_id").count().where("count > 1").isEmpty():
        return vectors, False
    return vectors.distinct(), True


def search(candidates: DataFrame, queries: DataFrame, k: int = 5, lists: int = LISTS, block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """The ``k`` best candidates of each query by inner product: query_id, rank (from 1), vec_id,
    score. Both sides have (vec_id, v) as ``scaled`` gives them. A row with the query's own id is
    no candidate of it. A row that repeats both id and vector counts once; different vectors of one
    id are all candidates, so an id may stand twice in a result, and the scores of all vectors of
    a query id are ranked together. Fewer candidates give fewer rows; an empty side gives none.
    Shorter vectors count as ending in zeros.

    Queries go in blocks of at most ``block`` rows, in the order of their ids; each block passes
    the candidates twice, and a task returns at most k rows per query."""
    spark = candidates.sparkSession
    candidates = stored(_once(candidates)[0], "search-vectors")
    queries, repeated = _once(queries)
    queries = stored(queries, "search-queries")
    width = max([r[0] or 0 for r in (candidates.agg(F.max(F.size("v"))).first(), queries.agg(F.max(F.size("v"))).first())])
    results, last = [], None
    while True:
        rest = queries
        if last is not None:
            later = F.col("vec_id") > last.vec_id
            rest = queries.where(later | (F.col("vec_id") == last.vec_id) & (F.col("v") > F.lit(last.v).cast("array<bigint>")) if repeated else later)
        rows = rest.orderBy("vec_id", "v").limit(block).collect()  # one block of bounded size
        if not rows or not width:
            break
        last = rows[-1]
        ids = np.array([r.vec_id for r in rows], np.int64)
        vectors = _matrix(pa.array([r.v for r in rows], pa.list_(pa.int64())), width)
        first = candidates.mapInArrow(_searched(k, vectors, ids, None, lists), _RESULT)
        lowest = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        safe = first.withColumn("rank", lowest).where(F.col("rank") <= k).groupBy("query_id").agg(
            F.min("score").alias("score"), F.count("*").alias("n")).collect()  # one row per query of the block
        at = {r.query_id: r.score for r in safe if r.n == k}
        cutoff = np.array([at.get(i, -(1 << 62)) for i in ids.tolist()], np.int64)
        found = candidates.mapInArrow(_searched(k, vectors, ids, cutoff, lists), _RESULT)
        results.append(stored(found.withColumn("rank", lowest).where(F.col("rank") <= k).select(
            "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "search-block"))
        if len(rows) < block:
            break
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    if repeated and len(results) > 1:  # the vectors of an id may stand in two blocks
        out = out.withColumn("rank", lowest.cast("int")).where(F.col("rank") <= k)
    return out
