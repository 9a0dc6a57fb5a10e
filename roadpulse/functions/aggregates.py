"""Grouped building blocks that pre-aggregate before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], columns: Mapping[str, Column], key: str, value: str) -> DataFrame:
    """One row per (row, entry of ``columns``)."""
    pairs = F.array(*[F.struct(F.lit(k).alias(key), c.alias(value)) for k, c in columns.items()])
    return df.select(*ids, F.explode(pairs).alias("_kv")).select(*ids, f"_kv.{key}", f"_kv.{value}")


def first_values(
    df: DataFrame, by: Sequence[str], fields: Mapping[str, Column], order: str,
    *, measures: Mapping[str, Column] | None = None, extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per group and field, the first non-null text in ``order``; equal positions go by the text.

    The distinct sets of texts of a group are found first, with a fixed-width minimum of
    ``order``: a hash aggregate without an explode, whose map side shrinks even a group that
    holds most rows. Only those sets are sorted for the picks. ``measures`` (fixed-width partial
    aggregates by name) ride in the same pass; ``extra`` are aggregates over the sets, which may
    use the fields and the measures.
    """
    sets = df.groupBy(*by, *[c.alias(n) for n, c in fields.items()]).agg(
        F.min(order).alias("_first"), *[c.alias(n) for n, c in (measures or {}).items()])
    pick = lambda n: F.min_by(n, F.when(F.col(n).isNotNull(), F.struct("_first", n))).alias(n)
    return sets.groupBy(*by).agg(*[pick(n) for n in fields], *[c.alias(n) for n, c in (extra or {}).items()])


def shares(df: DataFrame, by: Sequence[str], weight: str, share: str = "weight") -> DataFrame:
    """Finite positive weights divided by their group sum; other rows go.

    The sums are joined back rather than taken over a window, so no task has to hold a
    whole group; with few groups the adaptive plan broadcasts the measured sums.
    """
    positive = df.where((F.col(weight) > 0) & (F.col(weight) < float("inf")))
    totals = positive.groupBy(*by).agg(F.sum(weight).alias("_total"))
    return positive.join(totals, list(by)).select(
        *[c for c in df.columns if c != weight], (F.col(weight) / F.col("_total")).alias(share)
    )


def last_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The ``n`` rows ranked first by ``order``, per group when ``by`` is given."""
    if not by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
