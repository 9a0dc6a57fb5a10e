"""Benchmark decontamination with one FM-index per shard of training documents.

A shard is a slice of a partition. Its words become numbers (benchmark words; any other word ends
a run), the runs are indexed by suffix array, Burrows-Wheeler transform and wavelet matrix, and all
benchmark windows are searched backwards at once. Occurrences are located through sampled suffix
positions, mapped to words of documents, and merged to removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import clean_name, in_slices, shared_folder, with_column_type

WINDOW = 13
SAMPLED = 8  # every so many text positions keep their place in the index
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20  # benchmark text that a task searches at a time
LEAST_SHARE = 20  # contaminated from one hit word in so many

# Word bytes: 0-9, a-z (A-Z lower-cased) and everything beyond ASCII; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

RESULT = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<first:long,after:long>>,contaminated:boolean>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class Phrases:
    """Windows of a block of benchmark items: numbers per word, windows per length, items per window."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        numbers: dict[tuple[int, ...], int] = {}
        self.owners: list[set[str]] = []
        for item, text in items:
            own = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            for at in range(max(1, len(own) - window + 1) if own else 0):
                phrase = tuple(own[at : at + window])
                if numbers.setdefault(phrase, len(self.owners)) == len(self.owners):
                    self.owners.append(set())
                self.owners[numbers[phrase]].add(item)
        self.lengths = np.array([len(p) for p in numbers], np.int64)
        self.codes = np.zeros((len(numbers), window), np.int64)
        for row, phrase in enumerate(numbers):
            self.codes[row, window - len(phrase) :] = phrase  # last word in the last column
        self.shortest = int(self.lengths.min()) if len(numbers) else 0


class WaveletMatrix:
    """Rank and access over a sequence of small numbers, one bit vector per binary digit."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.n = len(values)
        self.digits = max(1, int(symbols).bit_length())
        for digit in reversed(range(self.digits)):
            bits = (values >> digit & 1).astype(bool)
            packed = np.zeros((self.n // 64 + 2) * 8, np.uint8)
            raw = np.packbits(bits, bitorder="little")
            packed[: len(raw)] = raw
            blocks = packed.view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(blocks), dtype=np.int64)])
            self.levels.append((blocks, before))
            self.zeros.append(self.n - int(bits.sum()))
            values = np.concatenate([values[~bits], values[bits]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        blocks, before = self.levels[level]
        block = at >> 6
        inside = blocks[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[block] + np.bitwise_count(inside)

    def descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` ends up among the rows of ``symbol`` in the last level."""
        for level, digit in enumerate(reversed(range(self.digits))):
            ones = self._ones(level, at)
            at = np.where(symbol >> digit & 1 == 1, self.zeros[level] + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for level in range(self.digits):
            ones = self._ones(level, at)
            bit = self._ones(level, at + 1) - ones
            symbol = symbol << 1 | bit
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return symbol


class FMIndex:
    """Index of runs of numbers from 1 to ``symbols``; 0 ends each run."""

    def __init__(self, text: np.ndarray, symbols: int):
        n, self.symbols = len(text), symbols
        ends = text == 0
        # Every end sorts by its place, before all words, so no comparison passes an end.
        rank = np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum()))
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:] + 1
            after[ends] = 0
            key = rank * (n + symbols + 2) + after
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                break
            width *= 2
        before = text[order - 1]  # the first position is preceded by the last, which is an end
        self.matrix = WaveletMatrix(before, symbols)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        every = np.arange(symbols + 1)
        self.origin = self.matrix.descend(every, np.zeros(symbols + 1, np.int64))
        # Located at once: sampled positions and starts of runs (an end cannot be stepped over).
        known = (order % SAMPLED == 0) | (before == 0)
        self.place = np.full(n, -1, np.int64)
        self.place[known] = order[known]

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.matrix.descend(symbol, at) - self.origin[symbol]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(window number, position) of every occurrence."""
        count = len(phrases.lengths)
        low, high = np.zeros(count, np.int64), np.full(count, self.matrix.n, np.int64)
        alive = np.arange(count)
        width = phrases.codes.shape[1]
        for step in range(width):
            moving = alive[phrases.lengths[alive] > step]
            if not len(moving):
                break
            symbol = phrases.codes[moving, width - 1 - step]
            low[moving], high[moving] = self._step(symbol, low[moving]), self._step(symbol, high[moving])
            alive = alive[low[alive] < high[alive]]
        sizes = high[alive] - low[alive]
        windows = np.repeat(alive, sizes)
        rows = np.repeat(low[alive] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum()) if len(alive) else windows
        return windows, self._locate(rows)

    def _locate(self, rows: np.ndarray) -> np.ndarray:
        found, steps = np.empty(len(rows), np.int64), 0
        open_rows, which = rows, np.arange(len(rows))
        while len(which):
            place = self.place[open_rows]
            done = place >= 0
            found[which[done]] = place[done] + steps
            open_rows, which = open_rows[~done], which[~done]
            open_rows = self._step(self.matrix.access(open_rows), open_rows)
            steps += 1
        return found


def shard_hits(texts: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, word after the last, window) of every occurrence in a shard."""
    nothing = (np.empty(0, np.int64),) * 4
    if not len(phrases.lengths):
        return nothing
    get = phrases.vocabulary.get
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # one end after each document
    codes = np.zeros(starts[-1], np.int64)
    for start, own in zip(starts.tolist(), texts, strict=False):
        codes[start : start + len(own)] = np.fromiter(map(get, own, repeat(0)), np.int64, len(own))
    # A run of benchmark words shorter than every window cannot hold one.
    ends = np.flatnonzero(codes == 0)
    run = np.diff(np.concatenate([[-1], ends])) - 1
    long = run >= phrases.shortest
    first, size = ends[long] - run[long], run[long] + 1  # with its end
    if not len(first):
        return nothing
    offset = np.concatenate([[0], np.cumsum(size)])
    where = np.repeat(first - offset[:-1], size) + np.arange(offset[-1])
    windows, places = FMIndex(codes[where], len(phrases.vocabulary)).search(phrases)
    word = where[places]
    document = np.searchsorted(starts, word, side="right") - 1
    begin = word - starts[document]
    return document, begin, begin + phrases.lengths[windows], windows


def merged(first: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """Removal spans: overlapping and touching word ranges joined, ascending."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(after[order])
    opens = np.concatenate([[True], first[1:] > reach[:-1]])
    closes = np.concatenate([opens[1:], [True]])
    return list(zip(first[opens].tolist(), reach[closes].tolist(), strict=True))


def _blocks(benchmark: DataFrame, id_column: str, text_column: str) -> tuple[str, int]:
    """The benchmark in the shared folder, dealt by a hash into blocks of about BLOCK_BYTES."""
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"),
                             F.col(text_column).cast("string").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // BLOCK_BYTES))
    folder = shared_folder(benchmark.sparkSession, "benchmark-blocks")
    block = F.pmod(F.xxhash64("item", "text"), F.lit(count)).cast("int")
    items.withColumn("block", block).repartition(count, "block").write.partitionBy("block").parquet(folder)
    return folder, count


_held: dict[tuple[str, int, int], Phrases] = {}


def _phrases(folder: str, block: int, window: int) -> Phrases:
    """One block at a time stays in a worker."""
    key = (folder, block, window)
    if key not in _held:
        store, root = pafs.FileSystem.from_uri(f"{folder}/block={block}")
        names = [f.path for f in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.path.endswith(".parquet")]
        tables = [pq.ParquetFile(store.open_input_file(name)).read(["item", "text"]) for name in sorted(names)]
        _held.clear()
        _held[key] = Phrases([(r["item"], r["text"]) for t in tables for r in t.to_pylist()], window)
    return _held[key]


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """All columns of ``docs`` and a struct column (``contamination``, or a variant that clashes
    with no column): n_words, n_hit, items, spans (word ranges to remove) and contaminated.

    A window is ``window`` consecutive words of a benchmark text, or the whole text where it has
    fewer; a document word inside an occurrence of a window is hit, and the document is
    contaminated if at least one word in 20 is. Null and empty texts have no words, on either side.
    A null item id counts as an empty one; items that share an id are one item. Repeated documents
    are judged alike. Nothing is shuffled: each task indexes its own documents, shard by shard, and
    searches the benchmark block by block."""
    name = clean_name(docs.columns, "contamination")
    at = [c.lower() for c in docs.columns].index(text_column.lower())
    folder, blocks = _blocks(benchmark, item_id, item_text)
    fields = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))), ("contaminated", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SHARD_BYTES):
            texts = [words(t) for t in part.column(at).to_pylist()]
            items: dict[int, set[str]] = {}
            ranges: dict[int, list] = {}
            for block in range(blocks):
                phrases = _phrases(folder, block, window)
                document, first, after, found = shard_hits(texts, phrases)
                for d in np.unique(document).tolist():
                    own = document == d
                    ranges.setdefault(d, []).append((first[own], after[own]))
                    items.setdefault(d, set()).update(*(phrases.owners[w] for w in np.unique(found[own]).tolist()))
            result = []
            for d, own in enumerate(texts):
                spans = merged(*(np.concatenate(side) for side in zip(*ranges[d], strict=True))) if d in ranges else []
                hit = sum(b - a for a, b in spans)
                result.append({"n_words": len(own), "n_hit": hit, "items": sorted(items.get(d, ())),
                               "spans": [{"first": a, "after": b} for a, b in spans], "contaminated": hit > 0 and LEAST_SHARE * hit >= len(own)})
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(result, fields)], names=[*part.schema.names, name])

    return docs.mapInArrow(run, with_column_type(docs.schema, name, RESULT))


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with the columns of ``docs``."""
    judged = contamination(docs, benchmark)
    return judged.where(~F.col(f"{judged.columns[-1]}.contaminated")).select(*[F.col(f"`{c}`") for c in docs.columns])
