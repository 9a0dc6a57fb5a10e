"""Line dedup with two Bloom filters, one for line keys seen once and one for keys seen twice.

Every task sets bits for its own lines; merging keeps, beside each union, the bits that both sides
had once. A key that stands in two documents has all its bits in the second filter, so only the
lines that pass it are shuffled, and exact counts over those decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import ASCII_SPACE, in_slices, shared_folder, stored

LEAST_LENGTH = 20
LEAST_DOCUMENTS = 3
BITS_PER_LINE = 16
HASHES = 2
SEGMENT_BITS = 1 << 23
# The filters never exceed this. Beyond about 64 million lines more of them pass by chance and are
# shuffled for the exact count; results stay the same.
MOST_BITS = 1 << 30
MERGED_AT_ONCE = 32
SLICE_BYTES = 8 << 20
NO_ID = -(1 << 63)


def keys_of(text: str | None) -> list[tuple[str, bytes | None]]:
    """Every line of a whole text (null or empty: one empty line) and its key: the line without
    ASCII white space at its ends, A-Z lower-cased; None below the least length."""
    found = []
    for line in (text or "").split("\n"):
        key = line.strip(ASCII_SPACE)
        found.append((line, key.encode().lower() if len(key) >= LEAST_LENGTH else None))
    return found


def _hashes(keys: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, keys), np.uint64, len(keys))


def _positions(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bit numbers of each hash; ``bits`` is a power of two."""
    mask = np.uint64(bits - 1)
    return [((hashes >> np.uint64(32 * n)) ^ (hashes << np.uint64(n))) & mask for n in range(HASHES)]


def _unpacked(data: bytes, bits: int) -> np.ndarray:
    """A segment's bitmap from either form: a bitmap of full size, or sorted bit numbers."""
    size = min(bits, SEGMENT_BITS) // 8
    if len(data) == size + 1:
        return np.frombuffer(data, np.uint8, size)
    flags = np.zeros(size * 8, bool)
    flags[np.frombuffer(data, "<u4")] = True
    return np.packbits(flags, bitorder="little")


def _packed(numbers: np.ndarray, bits: int) -> bytes:
    """Sorted bit numbers, or a bitmap (one byte longer, to tell them apart) where that is smaller."""
    size = min(bits, SEGMENT_BITS) // 8
    if 4 * len(numbers) < size:
        return numbers.astype("<u4").tobytes()
    flags = np.zeros(size * 8, bool)
    flags[numbers] = True
    return np.packbits(flags, bitorder="little").tobytes() + b"\0"


def _task_bits(bits: int):
    """Per task and segment: the bits of keys seen once, and of keys seen in two documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, often = np.empty(0, np.uint64), np.empty(0, np.uint64)
        waiting: list[np.ndarray] = []

        def fold():
            nonlocal seen, often
            own, counts = np.unique(np.concatenate(waiting), return_counts=True)
            often = np.union1d(often, np.concatenate([own[counts > 1], np.intersect1d(own, seen)]))
            seen = np.union1d(seen, own)
            waiting.clear()

        for part in in_slices(batches, SLICE_BYTES):
            for text in part["text"].to_pylist():
                waiting.append(_hashes(list({k for _, k in keys_of(text) if k is not None})))
            fold()
        number = TaskContext.get().partitionId()
        once, twice = (np.unique(np.concatenate(_positions(h, bits))) for h in (seen, often))
        size = min(bits, SEGMENT_BITS)
        for segment in np.unique(once // np.uint64(size)).tolist():
            low, high = np.uint64(segment * size), np.uint64((segment + 1) * size)
            cut = [x[np.searchsorted(x, low) : np.searchsorted(x, high)] - low for x in (once, twice)]
            yield pa.RecordBatch.from_arrays([
                pa.array([segment], pa.int32()), pa.array([number], pa.int32()), *(pa.array([_packed(x, bits)], pa.binary()) for x in cut)],
                names=["segment", "part", "once", "twice"])

    return run


def _merge(bits: int):
    """One row of a segment from several."""

    def run(rows):
        once, twice = _unpacked(b"", bits).copy(), _unpacked(b"", bits).copy()
        for a, b in zip(rows["once"], rows["twice"], strict=True):
            own = _unpacked(bytes(a), bits)
            twice |= _unpacked(bytes(b), bits) | (once & own)
            once |= own
        out = rows.iloc[:1][["segment", "part"]].copy()
        out["once"], out["twice"] = [once.tobytes() + b"\0"], [twice.tobytes() + b"\0"]
        return out

    return run


def twice_seen(lines: DataFrame, bits: int) -> str:
    """Folder of the filter of keys that may stand in two documents: one row per segment.
    Bits are merged in groups of MERGED_AT_ONCE, so a task holds a few megabytes."""
    schema = "segment int, part int, once binary, twice binary"
    level = stored(lines.mapInArrow(_task_bits(bits), schema), "line-bits")
    while (level.agg(F.max("part")).first()[0] or 0) > 0:
        grouped = level.withColumn("part", F.floor(F.col("part") / MERGED_AT_ONCE).cast("int")).groupBy("segment", "part")
        level = stored(grouped.applyInPandas(_merge(bits), schema), "line-bits")
    folder = shared_folder(lines.sparkSession, "line-filter")
    level.select("segment", "twice").write.parquet(folder)
    return folder


_held: dict[str, np.ndarray] = {}


def _filter(folder: str, bits: int) -> np.ndarray:
    """The whole filter, at most MOST_BITS; one at a time stays in a worker."""
    if folder not in _held:
        _held.clear()
        store, root = pafs.FileSystem.from_uri(folder)
        flags = np.zeros(max(bits // 8, 1), np.uint8)
        size = min(bits, SEGMENT_BITS) // 8
        for info in store.get_file_info(pafs.FileSelector(root)):
            if info.path.endswith(".parquet"):
                for row in pq.ParquetFile(store.open_input_file(info.path)).read().to_pylist():
                    flags[row["segment"] * size : (row["segment"] + 1) * size] = _unpacked(row["twice"], bits)
        _held[folder] = flags
    return _held[folder]


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _suspects(folder: str, bits: int):
    """(doc, key digest) of the keys that pass the filter, once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = _filter(folder, bits)
        for part in in_slices(batches, SLICE_BYTES):
            own = [list({k for _, k in keys_of(t) if k is not None}) for t in part["text"].to_pylist()]
            docs = np.repeat(part["doc"].to_numpy(), [len(k) for k in own])
            flat = [k for keys in own for k in keys]
            passed = np.ones(len(flat), bool)
            for at in _positions(_hashes(flat), bits):
                passed &= flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1
            yield pa.RecordBatch.from_arrays([
                pa.array(docs[passed]), pa.array([_digest(flat[n]) for n in np.flatnonzero(passed)], pa.binary())], names=["doc", "key"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose keys are in ``dropped``."""
    for part in in_slices(batches, SLICE_BYTES):
        rows = []
        for text, dropped in zip(part["text"].to_pylist(), part["dropped"].to_pylist(), strict=True):
            lines = keys_of(text)
            gone = set(dropped or ())
            kept = [line for line, key in lines if not gone or key is None or _digest(key) not in gone]
            rows.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
        yield pa.RecordBatch.from_arrays([
            part["doc_id"], pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept"])


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and kept (the text that is left) of every document.

    A key of at least LEAST_LENGTH code points that stands in at least LEAST_DOCUMENTS documents
    keeps its lines only in the largest id that holds it. A null or empty text is one empty line.
    Rows that share an id are one document when keys are counted; a null id is an id of its own,
    the smallest. An empty table gives no rows."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    lines = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), "text")
    count = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    bits = min(MOST_BITS, max(1 << 16, 1 << (BITS_PER_LINE * count).bit_length()))
    folder = twice_seen(lines, bits)
    suspects = stored(lines.mapInArrow(_suspects(folder, bits), "doc long, key binary").distinct(), "suspect-lines")
    counts = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= LEAST_DOCUMENTS)
    # Stored, so that the join below has plain exchanges and a very common key can be split.
    often = stored(counts.select("key", "keeper"), "repeated-lines")
    gone = suspects.join(often, "key").where("doc <> keeper").groupBy("doc").agg(
        F.collect_list("key").alias("dropped"))
    joined = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID))).join(gone, "doc", "left").select("doc_id", "text", "dropped")
    return joined.mapInArrow(_cut, "doc_id long, n_lines long, n_dropped long, kept string")
