"""Sharding by histogram sort: splitters are refined on exact byte counts, rows move once.

Documents are ordered by (hash of the text, document id), so equal texts are neighbours. For each
inner boundary the bytes below candidate keys are counted over all partitions; the interval that
holds the wanted position is cut again until a boundary is within tolerance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import stored

HEAD_BYTES = 16
TOLERANCE = 0.005
PROBES = 256
ROWS_PER_RUN = 20_000
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


@dataclass
class Bracket:
    """What is known of one boundary: it lies in [low, high] of ``column``; ``below`` bytes come
    before ``low``. ``text_hash`` is set once the search goes on inside one group of equal texts."""

    wanted: int
    low: int
    high: int
    below: int
    text_hash: int | None = None
    found: tuple[int, int] | None = None  # rows at or above this (text hash, id) belong to the right


def keyed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the ordering key (h, d) of every document, stored once."""
    text = F.col(text_column).cast("string")
    return stored(docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + HEAD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST)).alias("d"),
    ), "shard-keys")


def _probes(low: int, high: int) -> list[int]:
    """Lower edges of at most PROBES equal steps over low..high."""
    step = max(1, -(-(high - low + 1) // PROBES))
    return list(range(low, high + 1, step))


def _histogram(keys: DataFrame, open_brackets: list[Bracket]) -> dict[tuple, list[tuple[int, int, int, int]]]:
    """For each distinct open interval: (step number, bytes, least key, largest key) of the steps
    that hold rows. One pass; the result has at most PROBES rows per boundary."""
    spans = sorted({(b.text_hash, b.low, b.high) for b in open_brackets}, key=lambda s: (s[0] is not None, s[0] or 0, s[1]))
    cases = None
    for number, (text_hash, low, high) in enumerate(spans):
        step = max(1, -(-(high - low + 1) // PROBES))
        key = F.col("h") if text_hash is None else F.col("d")
        inside = key.between(low, high) if text_hash is None else (F.col("h") == text_hash) & key.between(low, high)
        # Any order-keeping step number will do; whole numbers once the interval is narrow.
        wide = F.floor((key.cast("double") - float(low)) / float(step))
        place = wide if high - low >= 1 << 52 else F.floor((key - low) / step)
        value = F.struct(F.lit(number).alias("span"), place.cast("long").alias("step"), key.alias("key"))
        cases = F.when(inside, value) if cases is None else cases.when(inside, value)
    # Several boundaries may lie in one interval; it is counted once.
    counted = keys.select("size", cases.alias("at")).where("at is not null").groupBy("at.span", "at.step").agg(
        F.sum("size").alias("size"), F.min("at.key").alias("least"), F.max("at.key").alias("most"))
    found: dict[tuple, list] = {span: [] for span in spans}
    for row in counted.collect():
        found[spans[row.span]].append((row.step, row["size"], row.least, row.most))
    return {span: sorted(steps) for span, steps in found.items()}


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """The lower keys of shards 1, 2, ...; bytes on each side differ from the ideal by at most
    ``tolerance`` of a shard, or by one document where that is larger. A boundary falls between
    two texts unless a single group of equal texts is wider than the tolerance."""
    total = keys.agg(F.sum("size")).first()[0]
    if not total or shards < 2:
        return []
    slack = tolerance * total / shards
    brackets = [Bracket(total * k // shards, _LEAST, _MOST, 0) for k in range(1, shards)]
    while open_brackets := [b for b in brackets if b.found is None]:
        steps = _histogram(keys, open_brackets)
        for b in open_brackets:
            below = b.below
            for _, size, least, most in steps[(b.text_hash, b.low, b.high)]:
                if b.wanted - below <= slack and b.wanted >= below:  # right before this step
                    b.found = (least, _LEAST) if b.text_hash is None else (b.text_hash, least)
                    break
                if below + size <= b.wanted:
                    below += size
                    continue
                if below + size - b.wanted <= slack:  # right after it
                    b.found = (most + 1, _LEAST) if b.text_hash is None else (b.text_hash, most + 1)
                elif least == most and b.text_hash is None:  # one text, wider than the tolerance: go on by id
                    b.text_hash, b.low, b.high, b.below = least, _LEAST, _MOST, below
                elif least == most:  # one id: the nearer side
                    b.found = (b.text_hash, least + (2 * (b.wanted - below) > size))
                else:
                    b.low, b.high, b.below = least, most, below
                break
            else:
                b.found = (b.high, _MOST) if b.text_hash is None else (b.text_hash, b.high)
    return sorted(b.found for b in brackets)


def shard_of(h: Column, d: Column, lower: list[tuple[int, int]]) -> Column:
    """How many lower keys are at or below (h, d)."""
    number = F.lit(0)
    for a, b in lower:
        number = number + ((h > a) | ((h == a) & (d >= b))).cast("int")
    return number


def shard(docs: DataFrame, shards: int, tolerance: float = TOLERANCE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    size is the UTF-8 length plus 16, 0 plus 16 for a null text (text_crc32 is null then). Null and
    repeated ids are kept; null sorts first. An empty table gives no rows. Each shard's rows are
    numbered in runs, dealt by the id, so no task holds a shard; a run starts after the rows of
    the runs before it. The exchange is by (shard, run) and carries no text."""
    keys = keyed(docs, id_column, text_column)
    lower = splitters(keys, shards, tolerance)
    runs = max(1, -(-keys.count() // (shards * ROWS_PER_RUN)))
    placed = keys.select("doc_id", "size", "text_crc32", "h", "d", shard_of(F.col("h"), F.col("d"), lower).alias("shard"),
                         F.pmod(F.xxhash64("d", "h"), F.lit(runs)).cast("int").alias("run"))
    counts = placed.groupBy("shard", "run").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("shard", "run").orderBy("h", "d", "size")
    return placed.withColumn("place", F.row_number().over(own) - 1).join(bases, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).cast("long").alias("slot"))
