"""Alignment of two tokenizers over the same bytes, with an identity-map fast path.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model with byte fallback. Both
cut a text at every lone space, so a text is aligned piece by piece and each worker remembers the
alignment of the pieces it has met. Groups of one A id and the B id of the same bytes are counted
in vectors as long as A's vocabulary; only the links of all other groups are shuffled as pairs.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import in_slices, is_even, stored

# Text of one slice; the distinct pairs of a slice are what the pair shuffle moves.
SLICE_BYTES = 2 << 20
# Pieces in a worker's memory; beyond it only those of the slice at hand stay. It changes no result.
REMEMBERED = 300_000
# Pieces between two spaces that are encoded in one text, and texts at a time.
JOINED, PACKS = 200, 50
SPACE_MARK = "▁"

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Latin letters and then plain marks. A byte-level BPE cuts between them; B is asked at the start.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", ".,;:!?#$%&*"
_WORD_AND_MARKS = re.compile(f"([{_LETTERS}]+)([{re.escape(_MARKS)}]+)")
_ACROSS = re.compile(f"[{_LETTERS}][{re.escape(_MARKS)}]")
CARRIER = "a"

_PARTS = (
    "kind int, slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "same array<int>, links array<int>, codes array<long>, counts array<long>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


def _byte_level() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: visible Latin-1 characters stand
    for themselves, the other bytes in ascending order for the characters from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(visible))
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, the bytes of every id, and the B id of the same bytes for every A id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of, vocabulary = _byte_level(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, n in vocabulary.items():
            self.bytes_a[n] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes_b, own = [], {}
        self.cuts_at_marks = True
        for n in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(n)
            if self.b.is_byte(n):
                data = bytes([int(piece[3:5], 16)])
                own.setdefault(data, n)
            else:
                if SPACE_MARK in piece.lstrip(SPACE_MARK):
                    raise ValueError(f"a piece spans a space, so texts cannot be cut there: {piece!r}")
                self.cuts_at_marks &= _ACROSS.search(piece) is None
                data = piece.replace(SPACE_MARK, " ").encode()
                if not (self.b.is_control(n) or self.b.is_unknown(n)):
                    own[data] = n  # rather than the byte of that value
            self.bytes_b.append(data)
        self.same = np.array([own.get(x, -1) for x in self.bytes_a], np.int64)
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # An id and the mark after it: inside a group, or at the end of its side.
        self.text_a, self.text_b = (
            np.array([f"{n}{mark}" for mark in marks for n in range(size)], object)
            for marks, size in ((",|", len(self.bytes_a)), (",;", len(self.bytes_b))))

    def code(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.bytes_b) + b


class _Flat:
    """Runs of numbers end to end, found again by their number."""

    def __init__(self):
        self.values, self.used, self.starts = np.empty(1 << 16, np.int64), 0, []

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        if self.used + len(values) > len(self.values):
            self.values = np.concatenate([self.values[: self.used], np.empty(self.used + len(values), np.int64)])
        self.values[self.used : self.used + len(values)] = values
        self.starts.append(self.used + np.cumsum(sizes) - sizes)
        self.used += len(values)

    def take(self, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The runs numbered ``at``, which have these sizes, one after the other."""
        if len(self.starts) > 1:
            self.starts = [np.concatenate(self.starts)]
        first = self.starts[0][at] if len(at) else np.empty(0, np.int64)
        return self.values[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


class Aligner:
    """Remembers the alignment of every piece between lone spaces."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.marks: dict[str, int] = {}
        # Per piece: A ids, B ids, groups, links, links of same-bytes groups, other links, bytes that differ.
        self.sizes = np.empty((0, 7), np.int64)
        self.waiting: list[np.ndarray] = []
        self.same, self.pairs = _Flat(), _Flat()

    def _keep(self, pieces: set[str]) -> None:
        """Forgets all other pieces."""
        kept = [(p, n) for p in pieces if (n := self.number.get(p)) is not None]
        at = np.array([n for _, n in kept], np.int64)
        texts, sizes, same, pairs = self.texts, self.sizes, self.same, self.pairs
        self._forget()
        self.number = {p: n for n, (p, _) in enumerate(kept)}
        self.texts, self.sizes = [texts[n] for _, n in kept], sizes[at]
        for new, old, column in ((self.same, same, 4), (self.pairs, pairs, 5)):
            new.add(old.take(at, self.sizes[:, column]), self.sizes[:, column])

    def _settle(self) -> None:
        self.sizes, self.waiting = np.concatenate([self.sizes, *self.waiting]), []

    def _learn(self, pieces: set[str]) -> None:
        """Adds pieces. A word with marks after it is put together of the two."""
        whole, split = [], []
        for piece in pieces:
            found = self.v.cuts_at_marks and _WORD_AND_MARKS.fullmatch(piece)
            (split.append((piece, *found.groups())) if found else whole.append(piece))
        new_marks = {m for _, _, m in split}.difference(self.marks)
        carried = [CARRIER, *(CARRIER + m for m in new_marks)] if new_marks else []
        words = {w for _, w, _ in split}.union(carried).difference(self.number, whole)
        self._learn_whole([*whole, *words])
        self._settle()
        if new_marks:
            first = self.number[CARRIER]
            for m in new_marks:
                # What the carrier has with the marks beyond what it has alone.
                both = self.number[CARRIER + m]
                self.marks[m] = len(self.texts)
                self.texts.append(self.texts[both][len(self.texts[first]) :])
                sizes = self.sizes[both] - self.sizes[first]
                self.waiting.append(sizes[None])
                for flat, column in ((self.same, 4), (self.pairs, 5)):
                    run = flat.take(np.array([both]), self.sizes[both : both + 1, column])
                    flat.add(run[len(run) - sizes[column] :], sizes[column : column + 1])
            self._settle()
        if split:
            pairs = np.array([(self.number[w], self.marks[m]) for _, w, m in split], np.int64)
            for (piece, _, _), (w, m) in zip(split, pairs.tolist(), strict=True):
                self.number[piece] = len(self.texts)
                self.texts.append(self.texts[w] + self.texts[m])
            for flat, column in ((self.same, 4), (self.pairs, 5)):
                flat.add(flat.take(pairs.ravel(), self.sizes[pairs.ravel(), column]), self.sizes[pairs, column].sum(1))
            self.waiting.append(self.sizes[pairs].sum(1))
            self._settle()

    def _learn_whole(self, pieces: list[str]) -> None:
        """Adds pieces; a piece with white space at an end goes alone, the others many at a time
        with a lone space between them, which cuts both tokenizers."""
        alone = [p for p in pieces if p[0].isspace() or p[-1].isspace()]
        apart = set(alone)
        even = [p for p in pieces if p not in apart] if alone else pieces
        packs = [even[n : n + JOINED] for n in range(0, len(even), JOINED)] + [[p] for p in alone]
        for n in range(0, len(packs), PACKS):
            self._encode(packs[n : n + PACKS])

    def _encode(self, packs: list[list[str]]) -> None:
        joined = [" ".join(pack) for pack in packs]
        ids_a = [e.ids for e in self.v.a.encode_batch_fast([" " + j for j in joined], add_special_tokens=False)]
        ids_b = self.v.b.encode(joined, num_threads=1)
        good: list[tuple[list[str], list[int], list[int]]] = []
        for pack, text, a, b in zip(packs, joined, ids_a, ids_b, strict=True):
            if self._agree(text, a, b):
                good.append((pack, a, b))
            else:
                self._add(good)
                good = []
                for piece in pack:
                    one = self.v.a.encode(" " + piece, add_special_tokens=False).ids, self.v.b.encode(piece)
                    if self._agree(piece, *one):
                        self._add([([piece], *one)])
                    else:
                        self.number[piece] = len(self.texts)
                        self.texts.append("")
                        self.waiting.append(np.array([[0, 0, 0, 0, 0, 0, 1]], np.int64))
                        none = np.empty(0, np.int64)
                        self.same.add(none, np.zeros(1, np.int64))
                        self.pairs.add(none, np.zeros(1, np.int64))
        self._add(good)

    def _agree(self, text: str, a: list[int], b: list[int]) -> bool:
        want = b" " + text.encode()
        return b"".join(map(self.v.bytes_a.__getitem__, a)) == want == b"".join(map(self.v.bytes_b.__getitem__, b))

    def _add(self, packs: list[tuple[list[str], list[int], list[int]]]) -> None:
        if not packs:
            return
        v = self.v
        pieces = list(chain.from_iterable(p for p, _, _ in packs))
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in zip(*((a, b) for _, a, b in packs), strict=True))
        end_a, end_b = np.cumsum(v.len_a[a]), np.cumsum(v.len_b[b])
        ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        shared = end_a[np.isin(end_a, end_b, assume_unique=True)]
        if not np.isin(ends, shared, assume_unique=True).all():
            raise ValueError("a token spans a lone space; these tokenizers cannot be aligned by pieces")
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        in_a, in_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
        plain = (in_a == 1) & (in_b == 1) & (v.same[a[last_a]] == b[last_b])
        # Every stretch between two neighbouring ends of either side lies in one A and one B token: a link.
        stretch = np.union1d(end_a, end_b)
        other = ~plain[np.searchsorted(shared, stretch)]
        link_a, link_b = a[np.searchsorted(end_a, stretch)], b[np.searchsorted(end_b, stretch)]
        piece_of_link = np.searchsorted(ends, stretch)
        n = len(pieces)
        sizes = np.zeros((n, 7), np.int64)
        for column, at in enumerate((np.searchsorted(ends, end_a), np.searchsorted(ends, end_b), np.searchsorted(ends, shared),
                                     piece_of_link, piece_of_link[~other], piece_of_link[other])):
            sizes[:, column] = np.bincount(at, minlength=n)
        self.same.add(link_a[~other], sizes[:, 4])
        self.pairs.add(v.code(link_a[other], link_b[other]), sizes[:, 5])
        self.waiting.append(sizes)
        # The text of the groups: the A ids of a group, then its B ids.
        parts = np.empty(len(a) + len(b), object)
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = len(v.bytes_a), len(v.bytes_b)
        parts[np.arange(len(a)) + (last_b + 1 - in_b)[group_a]] = v.text_a[a + ends_a]
        parts[np.arange(len(b)) + (last_a + 1)[group_b]] = v.text_b[b + ends_b]
        parts, stops = parts.tolist(), np.cumsum(sizes[:, 0] + sizes[:, 1]).tolist()
        start = 0
        for piece, stop in zip(pieces, stops, strict=True):
            self.number[piece] = len(self.texts)
            self.texts.append("".join(parts[start:stop]))
            start = stop

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray], list[np.ndarray]]:
        """Per text: the counts of ids, groups and links (zeros without tokens), the text of its
        groups, the A ids of its same-bytes groups, and the codes of its other links."""
        pieces = [t.split(" ") if is_even(t) else _LONE_SPACE.split(t) for t in texts]
        flat = list(chain.from_iterable(pieces))
        if len(self.number) > REMEMBERED:
            self._keep(set(flat))
        found = list(map(self.number.get, flat))
        if None in found:
            gaps = [n for n, number in enumerate(found) if number is None]
            self._learn({flat[n] for n in gaps})
            for n in gaps:
                found[n] = self.number[flat[n]]
        at = np.array(found, np.int64)
        own = np.array([len(p) for p in pieces], np.int64)
        doc = np.repeat(np.arange(len(texts)), own)
        whole = np.bincount(doc, self.sizes[at, 6], minlength=len(texts)) == 0
        used, doc = at[whole[doc]], doc[whole[doc]]
        counts = [np.bincount(doc, self.sizes[used, n], minlength=len(texts)).astype(np.int64) for n in range(6)]
        bounds = np.cumsum(own).tolist()
        groups = [
            "".join([self.texts[n] for n in found[stop - size : stop]])[:-1] if ok else ""
            for size, stop, ok in zip(own.tolist(), bounds, whole.tolist(), strict=True)]
        same, pairs = (
            np.split(flat.take(used, self.sizes[used, n]), np.cumsum(counts[n])[:-1])
            for flat, n in ((self.same, 4), (self.pairs, 5)))
        return np.stack(counts[:4], 1), groups, same, pairs


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(Vocabularies(path_a, path_b))
    return _aligners[path_a, path_b]


def _lists(runs: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    values = np.concatenate(runs) if runs else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype())))


def _parts(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """Documents (kind 0) with the links of each, and slices of documents (kind 1) with the distinct
    pairs behind ``links`` and how often each occurs in the slice."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number = _aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for part in in_slices(batches, SLICE_BYTES):
            texts = [t or "" for t in part["text"].to_pylist()]
            full = [n for n, t in enumerate(texts) if t]
            n, none = len(texts), np.empty(0, np.int64)
            counts, groups = np.zeros((n, 4), np.int64), [""] * n
            same, links = [none] * n, [none] * n
            codes, often = none, none
            if full:
                counts[full], texts_of, same_of, pairs_of = aligner([texts[i] for i in full])
                codes, place, often = np.unique(np.concatenate(pairs_of), return_inverse=True, return_counts=True)
                places = np.split(place, np.cumsum([len(p) for p in pairs_of])[:-1])
                for i, text, s, p in zip(full, texts_of, same_of, places, strict=True):
                    groups[i] = hashlib.sha256(text.encode()).hexdigest() if digest and text else text
                    same[i], links[i] = s, p
            empty = pa.array([None] * n, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, number)), part["doc_id"],
                *(pa.array(counts[:, k].copy()) for k in range(4)), pa.array(groups, pa.string()),
                _lists(same, pa.int32()), _lists(links, pa.int32()), empty, empty,
            ], schema=_PART_SCHEMA)
            nothing = [pa.array([None], t) for t in _PART_SCHEMA.types[2:10]]
            yield pa.RecordBatch.from_arrays([
                pa.array([1], pa.int32()), pa.array([number], pa.int64()), *nothing,
                _lists([codes], pa.int64()), _lists([often], pa.int64()),
            ], schema=_PART_SCHEMA)
            number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(align, _PARTS), "aligned")


_PART_SCHEMA = pa.schema([
    ("kind", pa.int32()), ("slice", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()),
    ("same", pa.list_(pa.int32())), ("links", pa.list_(pa.int32())), ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])


def _pair_counts(parts: DataFrame, same: np.ndarray, size_b: int) -> DataFrame:
    """code (a * size_b + b), n and whether n is the highest of that b, over the whole corpus.

    Same-bytes groups are added up per task in a vector as long as A's vocabulary."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(same), np.int64)
        for batch in batches:
            total += np.bincount(batch["same"].flatten().to_numpy(), minlength=len(same))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found * size_b + same[found]), pa.array(total[found])], names=["code", "n"])

    plain = parts.where("kind = 0").select("same").mapInArrow(vectors, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    other = _slice_pairs(parts).groupBy("code").agg(F.sum("often").alias("n"))
    counts = stored(plain.unionByName(other).groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    best = counts.groupBy((F.col("code") % size_b).alias("b")).agg(F.max("n").alias("most"))
    counts = counts.join(best, F.col("code") % size_b == F.col("b"))
    return stored(counts.select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pair-counts")


def _slice_pairs(parts: DataFrame) -> DataFrame:
    pairs = parts.where("kind = 1").select("slice", F.posexplode(F.arrays_zip("codes", "counts")))
    return pairs.select("slice", "pos", F.col("col.codes").alias("code"), F.col("col.counts").alias("often"))


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a, b, n (links of the corpus that join these ids) and best (the highest n of that b)."""
    sizes = _aligner(path_a, path_b).v
    size_b = len(sizes.bytes_b)
    return _pair_counts(_parts(docs, path_a, path_b, True), sizes.same, size_b).select(
        F.floor(F.col("code") / size_b).cast("int").alias("a"), (F.col("code") % size_b).cast("int").alias("b"), "n", "best")


def alignments(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups, the text
    ``a1,a2|b1;a3|b2`` of its groups (with ``digest`` the SHA-256 of that text in hex).

    A document without tokens has zeros and an empty ``groups``: its text is null or empty, or one
    of the tokenizers does not give back the bytes of a space and the text. Every row of ``docs``
    gives one row: repeated ids and null ids stay apart, other columns are not looked at, however
    they are called. No rows give no rows. Ties: all A ids with the highest count of a B id are
    best. A very long text is a slice of its own and goes through one task at once.

    Documents are encoded once. The pair shuffle moves the distinct pairs of each slice, not the
    links of documents; documents meet the counts of their slice, which a slice's bytes bound.
    The driver sees one count per entry of A's vocabulary at most."""
    sizes = _aligner(path_a, path_b).v
    same, size_b = sizes.same, len(sizes.bytes_b)
    spark = docs.sparkSession
    parts = _parts(docs, path_a, path_b, digest)
    counts = _pair_counts(parts, same, size_b)
    mapped = spark.createDataFrame(pa.table({"code": np.flatnonzero(same >= 0) * size_b + same[same >= 0]}))
    often, best = np.zeros(len(same), np.int64), np.zeros(len(same), bool)
    known = counts.join(mapped, "code").toArrow()  # at most one row per entry of A's vocabulary
    often[known["code"].to_numpy() // size_b], best[known["code"].to_numpy() // size_b] = known["n"].to_numpy(), known["best"].to_numpy()

    def look_up(docs_of: pa.Table, counts_of: pa.Table) -> pa.Table:
        place = counts_of["pos"].to_numpy()
        n, top = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        n[place], top[place] = counts_of["n"].to_numpy(), counts_of["best"].to_numpy()
        sums, tops = np.zeros(docs_of.num_rows, np.int64), np.zeros(docs_of.num_rows, np.int64)
        for name, number, is_top in (("links", n, top), ("same", often, best)):
            lists = docs_of[name].combine_chunks()
            doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            at = lists.flatten().to_numpy()
            np.add.at(sums, doc, number[at])
            np.add.at(tops, doc, is_top[at])
        out = docs_of.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
        return out.add_column(5, "n_best", pa.array(tops)).add_column(6, "count_sum", pa.array(sums))

    own = _slice_pairs(parts).join(counts, "code").select(F.col("slice").alias("of"), "pos", "n", "best")
    rows = parts.where("kind = 0").select("slice", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "same", "links")
    return rows.groupBy("slice").cogroup(own.groupBy("of")).applyInArrow(look_up, RESULT)
