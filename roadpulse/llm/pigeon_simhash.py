"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into m boxes on a ring. If two fingerprints differ in at most t bits,
some box starts a chain whose first l boxes differ in at most l * t / m bits together, for every l.
With t = 4 and m = 13 the first three boxes of that chain are equal and the next three differ in
at most one bit, so at least two of those are equal too: these five boxes are the join key.
Candidates then need a whole viable chain before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import clean_name, in_slices, stored, with_column_type
from roadpulse.llm.connected import components

BITS = 64
MOST_BITS = 4
BOXES = 13
SHINGLE = 4
SEED = 42
# Keys with more fingerprints than this are split by one more box of the chain; those that are still
# fuller are linked through shared neighbours instead of by pairs.
PAIRED = 128
# Boxes with a budget up to two span fewer bits than this on the ring; the number of the key stands above them.
CHAIN_BITS = 48
SLICE_BYTES = 8 << 20


def fingerprint(text: str | None) -> int:
    """Majority of the bits of all 4-word shingle hashes, as a signed 64-bit number.
    A-Z is lower-cased, words are runs without ASCII white space; fewer than four words are one
    shingle, and no word (null, empty) gives 0."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: 1 - SHINGLE].tolist()
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)]
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.array(hashes[at : at + 4096], "<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and fp (signed 64 bits) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE_BYTES):
            values = [fingerprint(t) for t in part["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(values, pa.int64())], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _boxes(boxes: int = BOXES) -> list[tuple[int, int]]:
    """(first bit, width) of each box; widths differ by one at most."""
    edges = [BITS * k // boxes for k in range(boxes + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _budgets(boxes: int, most: int) -> list[int]:
    return [(n + 1) * most // boxes for n in range(boxes)]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _chains(boxes: int, most: int) -> list[tuple[int, list[int], list[int]]]:
    """The join keys as numbers of boxes: per start on the ring and per box that may differ among those
    with a budget of one, that start, the boxes that are equal, and the next boxes, those with a budget of two."""
    budgets = _budgets(boxes, most)
    equal, loose, wider = (budgets.count(n) for n in range(3))
    found = []
    for start in range(boxes):
        near = [(start + n) % boxes for n in range(equal + loose + wider)]
        for left_out in range(loose):
            used = near[:equal] + [b for n, b in enumerate(near[equal : equal + loose]) if n != left_out]
            found.append((start, used, near[equal + loose :]))
    return found


def _cut(number: int, start: int, used: list[int], boxes: int) -> Column:
    """How a key is cut out of a fingerprint: its number, the turn that puts the chain's start first, the bits of its boxes."""
    ring, mask = _boxes(boxes), 0
    for first, width in (ring[n] for n in used):
        mask |= ((1 << width) - 1) << (first - ring[start][0]) % BITS
    return F.struct(F.lit(number).cast("long").alias("number"), F.lit(ring[start][0]).alias("turn"), F.lit(mask).cast("long").alias("mask"))


def _keyed(rows: DataFrame, cuts: Column) -> DataFrame:
    """fp and key for each of ``cuts``. These are values of one literal: an expression for each key would
    make plans and generated code of megabytes, which the driver holds again for every step of a query."""
    turn = F.col("cut.turn")
    turned = F.call_function("shiftrightunsigned", "fp", turn).bitwiseOR(F.call_function("shiftleft", "fp", F.lit(BITS) - turn))
    key = F.shiftleft(F.col("cut.number"), CHAIN_BITS).bitwiseOR(turned.bitwiseAND(F.col("cut.mask")))
    return rows.select("fp", F.explode(cuts).alias("cut")).select("fp", key.alias("key"))


def chain_keys(prints: DataFrame, boxes: int = BOXES, most: int = MOST_BITS) -> DataFrame:
    """fp and key: one per start on the ring and per box that may differ among those with a budget of one."""
    return _keyed(prints, F.array(*[_cut(n, start, used, boxes) for n, (start, used, _) in enumerate(_chains(boxes, most))]))


def longer_keys(keys: DataFrame, boxes: int = BOXES, most: int = MOST_BITS) -> DataFrame:
    """fp and the keys that each row of ``chain_keys`` is split into: one more box of the chain, each
    of those with a budget of two in turn. At most two bits differ up to there, so of three such boxes
    one is equal: a pair that shares the short key and its chain shares one of the longer ones."""
    cuts = F.array(*[
        F.array(*[_cut(len(after) * n + m, start, [*used, box], boxes) for m, box in enumerate(after)])
        for n, (start, used, after) in enumerate(_chains(boxes, most))])
    return _keyed(keys, F.get(cuts, F.shiftrightunsigned("key", CHAIN_BITS).cast("int")))


def viable_chain(difference: Column, boxes: int = BOXES, most: int = MOST_BITS) -> Column:
    """Whether some start has a chain in which every first l boxes keep to the budget of l. The last
    length with a budget says it all, so a start has one mask per budget."""
    ring, budgets = _boxes(boxes), _budgets(boxes, most)
    lengths = [n + 1 for n, budget in enumerate(budgets) if n + 1 == boxes or budget != budgets[n + 1]]
    mask = lambda start, length: sum(
        ((1 << width) - 1) << first for first, width in (ring[(start + n) % boxes] for n in range(length)))
    masks = F.array(*[F.array(*[F.lit(_signed(mask(start, n))).cast("long") for n in lengths]) for start in range(boxes)])

    def viable(chain: Column) -> Column:
        kept = F.lit(True)
        for at, length in enumerate(lengths):
            kept = kept & (F.bit_count(difference.bitwiseAND(F.get(chain, F.lit(at)))) <= budgets[length - 1])
        return kept

    return F.exists(masks, viable)


def _full(keys: DataFrame, paired: int) -> DataFrame:
    return stored(keys.groupBy("key").count().where(F.col("count") > paired).select("key"), "full-keys")


def linked(prints: DataFrame, boxes: int = BOXES, most: int = MOST_BITS, paired: int = PAIRED) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` that have the same components as all pairs
    at ``most`` or fewer differing bits. Every pair that shares a key of at most ``paired``
    fingerprints is checked. A fingerprint keeps its link to a smaller one unless a still smaller
    one is linked to both: those two links reach the same, so by induction over (larger end, smaller
    end) no component is cut, and a group of near copies gives links by its size, not its pairs.
    Fuller keys, which come with many fingerprints, are split by one more
    box of the chain. Fingerprints whose longer keys are full as well, a group of near copies, go,
    each by itself, to all points within ``most`` / 2 bits: two that meet at a point are linked,
    and every linked pair meets, so a large group costs its size and not its square."""
    if most != 4 or _budgets(boxes, most).count(2) < 3:
        raise ValueError("longer keys and meeting points are built for 4 differing bits")
    before = Window.partitionBy("key").orderBy("fp").rowsBetween(-paired, -1)
    close = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= most
    near = F.filter("earlier", lambda o: viable_chain(o.bitwiseXOR(F.col("fp")), boxes, most) & close(o, F.col("fp")))
    needed = F.filter("near", lambda o: ~F.exists("near", lambda c: (c < o) & close(c, o)))

    def pairs(keys: DataFrame, full: DataFrame) -> DataFrame:
        dealt = keys.join(full, "key", "left_anti")
        rows = dealt.withColumn("earlier", F.collect_list("fp").over(before)).where(F.size("earlier") > 0)
        return rows.select("fp", near.alias("near")).select(F.col("fp").alias("a"), F.explode(needed).alias("b"))

    keys = chain_keys(prints, boxes, most)
    full = _full(keys, paired)
    found = pairs(keys, full)
    if full.isEmpty():
        return found
    longer = stored(longer_keys(keys.join(full, "key", "left_semi"), boxes, most), "longer-keys")
    fuller = _full(longer, paired)
    found = found.unionByName(pairs(longer, fuller))
    if fuller.isEmpty():
        return found
    crowded = longer.join(fuller, "key", "left_semi").select("fp").distinct()
    # All masks of at most two bits: bits i and j up to i, one bit where they are equal, none where j is -1.
    bit = lambda n: F.call_function("shiftleft", F.lit(1).cast("long"), F.col(n).cast("int"))
    points = stored(crowded, "crowded").repartition("fp").select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("i"))
    points = points.select("fp", "i", F.explode(F.sequence(F.when(F.col("i") == 0, -1).otherwise(0), F.col("i"))).alias("j"))
    points = points.select("fp", F.col("fp").bitwiseXOR(F.when(F.col("j") < 0, 0).otherwise(bit("i").bitwiseOR(bit("j")))).alias("point"))
    meeting = points.groupBy("point").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b != top").select("point", "b")
    return found.unionByName(points.join(meeting, "point").select(F.col("fp").alias("a"), "b").where("a != b").distinct())


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the smallest id among all documents that the links reach).

    Equal fingerprints are linked, so documents are first reduced to distinct fingerprints. Empty
    and null texts have fingerprint 0 and are linked like any other; texts of any length are taken
    whole, one at a time, and repeated rows share a component. A null id is kept, but gives
    its component no name (null if all ids of it are null). An empty table gives no rows."""
    return _rooted(docs, id_column, text_column).select("doc_id", "fp", "component_id")


def _rooted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``near_duplicates`` and the root of each component: two components may have one name where ids repeat."""
    own = stored(fingerprints(docs, id_column, text_column), "fingerprints")
    prints = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(linked(prints)).select(F.col("node").alias("fp"), "root")
    rooted = stored(prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    names = rooted.join(named, "root").select("fp", "root", "component_id")
    return own.join(names, "fp").select("doc_id", "fp", "root", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """Of each component only the row of its smallest (document id, fingerprint), with the columns
    of ``docs``. Rows of one id in different components are judged apart. Of rows that repeat the
    kept id and fingerprint one stays, chosen by a hash of the text and then by the other columns.
    Rows without an id stay, as no other row can stand for them."""
    found = stored(_rooted(docs), "rooted")
    first = found.where("doc_id = component_id").groupBy("root", "doc_id").agg(F.min("fp").alias("fp"))
    first = stored(first.select("doc_id", "fp"), "first")
    again = stored(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated-ids")
    # The joins by name keep the columns of ``docs``; a null id matches nothing.
    unnamed, ids = docs.where(F.col("doc_id").isNull()), first.select("doc_id").distinct()
    if again.isEmpty():
        return docs.join(ids, "doc_id", "left_semi").unionByName(unnamed)
    once = docs.join(again, "doc_id", "left_anti").join(ids, "doc_id", "left_semi")
    return once.unionByName(_of_repeated_ids(docs.join(again, "doc_id", "left_semi"), first)).unionByName(unnamed)


def _of_repeated_ids(docs: DataFrame, first: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand in ``first`` (doc_id, fp), one of each."""
    fp = clean_name(docs.columns, "fp")
    rank = clean_name(docs.columns, "rank")
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE_BYTES):
            values = [fingerprint(t) for t in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values, pa.int64())], names=[*part.schema.names, fp])

    printed = docs.mapInArrow(run, with_column_type(docs.schema, fp, "long"))
    kept = printed.join(first.withColumnRenamed("fp", fp), ["doc_id", fp], "left_semi")
    order = Window.partitionBy("doc_id", fp).orderBy(F.xxhash64("text"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
    return kept.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
