"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram is the product of its letters' vectors,
shifted by two, one and no places; a text is the sum of its trigrams, a language the sum of its
training texts. The language with the largest cosine to the text is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import clean_name, hashed_below, in_slices, with_column_type

DIMENSIONS = 1024
SEED = 20_250_101
ROWS = 1 << 14  # letter vectors: code points below 8192 have their own, others share by remainder
UNKNOWN = "und"
SLICE_BYTES = 2 << 20
TRIGRAMS_AT_ONCE = 4096
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors by row: shifted by two, by one, and as they are."""
    plain = (np.random.default_rng(SEED).integers(0, 2, (ROWS, DIMENSIONS), np.int8) * 2 - 1).astype(np.int8)
    return np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain


@lru_cache(maxsize=1)
def _rows() -> np.ndarray:
    """Row of every code point; what is no letter counts as a space."""
    points = np.arange(0x110000)
    row = np.where(points < ROWS // 2, points, ROWS // 2 + points % (ROWS // 2))
    letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    return np.where(letter, row, _SPACE).astype(np.int32)


def trigrams(text: str | None) -> np.ndarray:
    """Codes of all trigrams of a whole text, lower-cased, runs of other signs as one space.
    Empty if there is no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    rows = _rows()[points]
    rows = np.concatenate([[_SPACE], rows, [_SPACE]]).astype(np.int64)
    keep = np.concatenate([[True], (rows[1:] != _SPACE) | (rows[:-1] != _SPACE)])
    rows = rows[keep]
    return rows[:-2] << 28 | rows[1:-1] << 14 | rows[2:] if len(rows) > 2 else np.empty(0, np.int64)


def bundle(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the vectors of the given trigrams, each ``counts`` times; whole numbers."""
    two, one, plain = _letters()
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(codes), TRIGRAMS_AT_ONCE):
        c = codes[at : at + TRIGRAMS_AT_ONCE]
        bound = two[c >> 28] * one[c >> 14 & (ROWS - 1)] * plain[c & (ROWS - 1)]
        total += counts[at : at + TRIGRAMS_AT_ONCE].astype(np.float32) @ bound.astype(np.float32)
    return total


def _task_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language: the sum of all trigrams of its texts."""
    sums: dict[str, np.ndarray] = {}
    for part in in_slices(batches, SLICE_BYTES):
        gathered: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(part["text"].to_pylist(), part["lang"].to_pylist(), strict=True):
            gathered.setdefault(lang, []).append(trigrams(text))
        for lang, own in gathered.items():
            codes, counts = np.unique(np.concatenate(own), return_counts=True)
            sums[lang] = sums.get(lang, 0) + bundle(codes, counts)
    for lang, total in sums.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([lang]), pa.array([np.rint(total).astype(np.int64)], pa.list_(pa.int64()))], names=["lang", "v"])


def prototypes(docs: DataFrame, held_out) -> dict[str, np.ndarray]:
    """One vector per language, learnt from all texts with a language for whose ids ``held_out`` is
    false. Tasks send one vector per language; the driver gets the sums, 8 KB a language."""
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    parts = rows.mapInArrow(_task_sums, "lang string, v array<long>").select("lang", F.posexplode("v").alias("i", "x"))
    sums = parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    found = {r.lang: np.array([x.x for x in r.v], float) for r in sums.collect()}
    return {lang: v for lang, v in sorted(found.items()) if v.any()}


def languages(docs: DataFrame, held_out=lambda doc_id: hashed_below(doc_id, 4, 2)) -> DataFrame:
    """All columns of ``docs`` and a struct column (``language``, or a variant that clashes with no
    column) of lang and score, the cosine (0 to 1). Only ``text`` enters a prediction. A null text
    or one without a letter is ``und`` with score 0, as is every text if nothing could be learnt;
    ties go to the language first in order."""
    known = prototypes(docs, held_out)
    names = list(known)
    unit = np.stack([v / np.linalg.norm(v) for v in known.values()]) if known else np.zeros((0, DIMENSIONS))
    name = clean_name(docs.columns, "language")
    at = [c.lower() for c in docs.columns].index("text")

    def judge(text: str | None) -> tuple[str, float]:
        codes, counts = np.unique(trigrams(text), return_counts=True)
        if not len(codes) or not names:
            return UNKNOWN, 0.0
        own = bundle(codes, counts)
        cosine = unit @ own / max(np.linalg.norm(own), 1e-300)
        best = int(cosine.argmax())
        return names[best], float(np.clip(cosine[best], 0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, SLICE_BYTES):
            found = [judge(t) for t in part.column(at).to_pylist()]
            result = pa.StructArray.from_arrays(
                [pa.array([lang for lang, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["lang", "score"])
            yield pa.RecordBatch.from_arrays([*part.columns, result], names=[*part.schema.names, name])

    return docs.mapInArrow(run, with_column_type(docs.schema, name, "struct<lang:string,score:double>"))
