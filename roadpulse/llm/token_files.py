"""Token-id output: flat unsigned integer files with 64-bit document offsets.

Layout below one folder:

* ``ids-*.bin``      token ids, little-endian, 16 bits where the vocabulary fits, else 32
* ``offsets-*.bin``  unsigned 64-bit positions in that file, one more than documents
* ``docs-*.bin``     signed 64-bit document ids (the smallest value stands for null)
* ``manifest``       Parquet, one row per file: number, base (ids in all files before), counts, names

Files and the documents in them ascend by document id. Every task writes under a name of its
own; the manifest names only the files of tasks that ended well, so a repeated or lost task
leaves at most unnamed files.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import in_slices

SLICE_BYTES = 4 << 20
# Pieces in one generation of a worker's memory; it changes no result.
REMEMBERED = 500_000
# Pieces that are encoded in one text.
JOINED = 200
NULL_DOC = -(1 << 63)

MANIFEST = (
    "file_no int, base long, n_docs long, n_tokens long, width int, "
    "ids_file string, offsets_file string, docs_file string"
)
_PARTS = "file_no int, n_docs long, n_tokens long, width int, ids_file string, offsets_file string, docs_file string"

# A single space between two other characters always starts a new unit of a byte-level
# tokenizer; next to further white space it may not.
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# A space at an end of the text or beside other white space; texts without one are cut at every space.
_WHITE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNEVEN = f"^ | $| [{_WHITE}]|[{_WHITE}] "
# Latin letters and then plain marks: letters and marks are units of their own.
_WORD_AND_MARKS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?#$%&*]+)")

_encoders: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Encodes texts by pieces between lone spaces and remembers the ids of each piece.
    The result equals encoding the whole texts with a byte-level tokenizer that has no normaliser.

    Two generations are remembered: pieces that come again move to the young one, and when
    that is full it becomes the old one. So memory is bounded and frequent pieces stay known."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # Bytes of each id: every character of a byte-level entry stands for one.
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.lengths[list(vocabulary.values())] = list(map(len, vocabulary))
        self.spaced: dict[str, bytes] = {}  # ids of a piece with a space before it
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece."""
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array(self.dtype.char, e.ids).tobytes() for e in encoded]

    def _spaced_ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece after a space. Many pieces are encoded in one text and its ids cut
        where the bytes of a piece end; a piece that ends in white space would not be cut there."""
        out = []
        for start in range(0, len(pieces), JOINED):
            pack = pieces[start : start + JOINED]
            (encoded,) = self.tokenizer.encode_batch_fast([" " + " ".join(pack)], add_special_tokens=False)
            ids = np.array(encoded.ids, self.dtype)
            ends = np.cumsum([len(p.encode()) + 1 for p in pack])
            cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            if cuts[-1] != len(ids):
                raise ValueError("a token spans a lone space; texts cannot be cut there")
            data, width = ids.tobytes(), self.dtype.itemsize
            bounds = [0, *(cuts * width).tolist()]
            out += [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Adds pieces that follow a lone space, so that they start with something else."""
        new, split, alone = [], [], []
        for p in pieces:
            if (ids := self.old.get(p)) is not None:
                self.spaced[p] = ids
            elif m := _WORD_AND_MARKS.fullmatch(p):
                split.append((p, *m.groups()))
            else:
                (alone if p[-1].isspace() else new).append(p)
        words = {word for _, word, _ in split} - pieces
        for word in words:
            if (ids := self.old.get(word)) is not None:
                self.spaced[word] = ids
        new += [w for w in words if w not in self.spaced]
        self.spaced.update(zip(new, self._spaced_ids(new), strict=True))
        self.spaced.update(zip(alone, self._ids([" " + p for p in alone]), strict=True))
        marks = list({m for _, _, m in split} - self.marks.keys())
        self.marks.update(zip(marks, self._ids(marks), strict=True))
        self.spaced.update((p, self.spaced[word] + self.marks[m]) for p, word, m in split)

    def __call__(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each followed by ``end``, and how many ids each
        has. Every different piece of the texts is looked up once; the rest is done with arrays."""
        if len(self.spaced) > REMEMBERED:
            self.old, self.spaced = self.spaced, {}
        if len(self.marks) > REMEMBERED:
            self.marks.clear()
        pieces = pc.split_pattern(texts, " ")
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        if pc.any(uneven).as_py():
            lists = [_LONE_SPACE.split(t.as_py()) if odd else p.as_py() for t, odd, p in zip(texts, uneven.to_pylist(), pieces, strict=True)]
            pieces = pa.array(lists, pa.list_(pa.string()))
        coded = pieces.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # The first piece of a text has no space before it: a run of its own.
        bounds = pieces.offsets.to_numpy().astype(np.int64) - pieces.offsets[0].as_py()
        at = coded.indices.to_numpy().astype(np.int64)
        firsts = at[bounds[:-1]]
        at[bounds[:-1]] = len(different) + np.arange(len(texts))
        used = np.zeros(len(different) + len(texts), bool)
        used[at] = True
        found = list(map(self.spaced.get, different))
        if missing := [n for n, ids in enumerate(found) if ids is None and used[n]]:
            self._learn({different[n] for n in missing})
            for n in missing:
                found[n] = self.spaced[different[n]]
        runs = [ids or b"" for ids in found]
        runs += self._ids([different[n] for n in firsts.tolist()])
        runs.append(end)
        at = np.insert(at, bounds[1:], len(runs) - 1)
        data, sizes = np.frombuffer(b"".join(runs), self.dtype), np.fromiter(map(len, runs), np.int64, len(runs)) // self.dtype.itemsize
        own = sizes[at]
        stops = np.cumsum(own)
        starts = (np.cumsum(sizes) - sizes)[at]
        ids = data[np.repeat(starts - (stops - own), own) + np.arange(stops[-1] if len(stops) else 0)]
        return ids, np.diff(stops[bounds[1:] + np.arange(len(texts))], prepend=0)


def _encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Encode every whole text and write the files below ``folder``; returns the stored manifest.

    Each document's ids are those of its text and then ``end_id``. A null or empty text is
    ``end_id`` alone. A null document id sorts first. Repeated ids are all kept, next to each
    other, ordered by a hash of the text. No document at all gives an empty manifest.

    One exchange, by id ranges; the ids are never shuffled. The driver sees one row per file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    schema = pa.schema([("file_no", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()),
                        ("ids_file", pa.string()), ("offsets_file", pa.string()), ("docs_file", pa.string())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        end = np.array([end_id], encode.dtype).tobytes()
        store, root = pafs.FileSystem.from_uri(folder)
        number, ids, ends, names = TaskContext.get().partitionId(), [], [0], None
        out = None
        for part in in_slices(batches, SLICE_BYTES):
            if out is None:
                tag = f"{number:06d}-{uuid.uuid4().hex[:12]}"
                names = [f"{kind}-{tag}.bin" for kind in ("ids", "offsets", "docs")]
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/{names[0]}")
            ids.append(np.asarray(part["doc_id"].fill_null(NULL_DOC), np.int64))
            data, counts = encode(part["text"].fill_null(""), end)
            out.write(data.tobytes())
            ends += (ends[-1] + np.cumsum(counts)).tolist()
        if out is None:
            return
        out.close()
        for name, values in ((names[1], np.array(ends, "<u8")), (names[2], np.concatenate(ids).astype("<i8"))):
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(values.tobytes())
        row = [number, len(ends) - 1, ends[-1], encode.dtype.itemsize, *names]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

    # Committed file names first, as a table; a task that runs again cannot change what is in it.
    rows.mapInArrow(write, _PARTS).write.parquet(f"{folder}/written")
    written = sorted(spark.read.schema(_PARTS).parquet(f"{folder}/written").collect())  # one short row per file
    bases = np.concatenate([[0], np.cumsum([r.n_tokens for r in written])]).astype(int).tolist()
    manifest = [(r.file_no, base, *r[1:]) for r, base in zip(written, bases, strict=False)]
    spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files below ``folder``: doc_id, start (ids before it), n_tokens,
    ids_crc32 (over the ids as little-endian 32-bit integers), file_no. Files are memory-mapped
    where the store is local; a task holds the ids of one document at a time."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("file_no", pa.int32())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids = _mapped(store, f"{root}/{row['ids_file']}", "<u2" if row["width"] == 2 else "<u4")
                offsets = _mapped(store, f"{root}/{row['offsets_file']}", "<u8").astype(np.int64)
                numbers = np.array(_mapped(store, f"{root}/{row['docs_file']}", "<i8"))
                for at in range(0, len(numbers), 10_000):
                    own, bounds = numbers[at : at + 10_000], offsets[at : at + 10_001]
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own, mask=own == NULL_DOC), pa.array(bounds[:-1] + row["base"]), pa.array(np.diff(bounds)),
                        pa.array(sums, pa.int64()), pa.array(np.full(len(own), row["file_no"], np.int32)),
                    ], schema=schema)

    files = max(1, manifest.count())
    return manifest.repartition(files).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file_no int")


def _mapped(store: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)
