"""Toxicity by compression distance between two zstandard dictionaries.

Texts are coded unit by unit (a word or the stem of a longer one, as eight bytes of a hash), so
that a dictionary match is a match of whole units. The ordinary dictionary holds the commonest units
of ordinary training texts; the toxic one holds the same and, before it, the units that toxic texts
use in clearly more contexts.
A window that the toxic dictionary compresses better carries toxic wording; the gains of all
windows of a text give its score through a calibrated logistic curve.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import clean_name, hashed_below, in_slices, stored, with_column_type

# The classifier is fitted on so many labelled documents of each class at most, chosen by a hash
# of their ids; everything else works on all documents.
SAMPLE_PER_CLASS = 6000
WINDOW_UNITS = 64
STEM = 5
# A level that looks up every dictionary position: below it, hash slots taken by the one content or the
# other change which ordinary matches are found, and the gains are noisy.
LEVEL = 5
COMMON_WORDS = 4096
TOXIC_WORDS = 8192
# A unit tells toxic texts if its use there is this surprising (log-likelihood ratio) and this much more frequent.
LEAST_SURPRISE, LEAST_RATIO = 25.0, 8.0
PREDICTED_FROM = 0.7
RIDGE = 0.002
# A matched unit saves its eight bytes less a reference of up to four.
UNIT_GAIN = 4
SLICE_BYTES = 8 << 20
_MARKS = ".,;:!?\"()*#&%$|"
_PLAIN = bytes.maketrans(_MARKS.encode(), b" " * len(_MARKS))


@dataclass(frozen=True)
class Model:
    """Dictionary contents and the calibrated curve."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def units(text: str | None) -> list[bytes]:
    """Of every word of a whole text (without marks, lower-cased): the word, and its stem of
    STEM bytes if it is longer, marked as such."""
    found = []
    for word in (text or "").lower().encode().translate(_PLAIN).split():
        found.append(word)
        if len(word) > STEM:
            found.append(word[:STEM] + b"-")
    return found


class Gains:
    """Bytes that the toxic dictionary saves per window, against the ordinary one."""

    def __init__(self, model: Model):
        import zstandard as z
        from xxhash import xxh3_64_digest

        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.compress = []
        # Codes of no word, so that both dictionaries have one size and zstandard's tables are alike.
        filler = b"".join(xxh3_64_digest(b"\0no word %d" % n) for n in range(max(1, len(model.toxic) // 8)))
        for content in (filler, model.toxic or filler):
            held = z.ZstdCompressionDict(content + model.ordinary, dict_type=z.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.compress.append(z.ZstdCompressor(level=LEVEL, dict_data=held, **plain).compress)

    def __call__(self, text: str | None) -> tuple[int, int]:
        """Largest gain of a window and the sum of all positive gains, over the whole text."""
        from xxhash import xxh3_64_digest

        coded, most, total = b"".join(map(xxh3_64_digest, units(text))), 0, 0
        ordinary, toxic = self.compress
        for at in range(0, len(coded), 8 * WINDOW_UNITS):
            window = coded[at : at + 8 * WINDOW_UNITS]
            gain = len(ordinary(window)) - len(toxic(window))
            if gain > 0:
                total += gain
                most = max(most, gain)
        return most, total


def _features(gains: np.ndarray) -> np.ndarray:
    """A constant, whether a window gains as much as a unit saves, the largest gain, and the sum."""
    return np.stack([np.ones(len(gains)), gains[:, 0] >= UNIT_GAIN, np.minimum(gains[:, 0], 12) / 4, np.log1p(gains[:, 1])], axis=1)


def _score(model: Model, gains: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_features(gains) @ np.array(model.weights), -30, 30)))


def _calibrated(gains: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, ...]:
    """Logistic curve by Newton steps, the classes weighted to their share among all labels."""
    if len(toxic) == 0 or toxic.min() == toxic.max():
        odds = np.clip(share, 1e-4, 1 - 1e-4)
        return (float(np.log(odds / (1 - odds))), 0.0, 0.0, 0.0)
    x = _features(gains)
    weight = np.where(toxic == 1, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    w, ridge = np.zeros(4), np.diag([1e-6, RIDGE, RIDGE, RIDGE])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x / len(x) + ridge,
                               x.T @ (weight * (toxic - p)) / len(x) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def _contexts(sample: DataFrame) -> DataFrame:
    """word (a unit), and in how many different (unit before, unit after) it stands in toxic and in
    ordinary texts. Copies of one passage so count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for part in in_slices(batches, SLICE_BYTES):
            for text, toxic in zip(part["text"].to_pylist(), part["toxic"].to_pylist(), strict=True):
                own = units(text)
                seen = {(w, xxh3_64_intdigest(b" ".join((a, b))) >> 1) for a, w, b in zip([b"", *own], own, [*own[1:], b""], strict=False)}
                if seen:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([w for w, _ in seen], pa.binary()), pa.array([c for _, c in seen], pa.int64()),
                        pa.array(np.full(len(seen), toxic, np.int32))], names=["word", "context", "toxic"])

    uses = sample.select("text", "toxic").mapInArrow(run, "word binary, context long, toxic int").distinct()
    return uses.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))


def fit(docs: DataFrame, labels: DataFrame, held_out) -> Model:
    """Learn from labelled documents for which ``held_out`` (a function of the id column) is false.
    Two thirds of the sample make the dictionaries, one third the curve."""
    from xxhash import xxh3_64_digest

    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    # The first of each class by hash: a top-k, which no task sorts a whole class for.
    first = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_CLASS) for k in (0, 1)]
    chosen = first[0].unionByName(first[1]).select(
        F.col("doc_id").alias("id"), "toxic", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0).alias("for_curve"))
    toxic_share = usable.agg(F.avg("toxic")).first()[0] or 0.0
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")), "toxicity-sample")
    uses = stored(_contexts(sample.where("not for_curve")), "toxicity-words")
    toxic_uses, other_uses = uses.agg(F.sum("t"), F.sum("o")).first()
    if toxic_uses and other_uses:
        share = toxic_uses / (toxic_uses + other_uses)
        t, o = F.col("t"), F.col("o")
        surprise = 2 * (t * F.log(t / ((t + o) * share)) + F.when(o > 0, o * F.log(o / ((t + o) * (1 - share)))).otherwise(0.0))
        ratio = t * float(other_uses) / ((o + 0.5) * float(toxic_uses))
        telling = uses.where((t > 0) & (surprise >= LEAST_SURPRISE) & (ratio >= LEAST_RATIO))
        toxic = [r.word for r in telling.orderBy(F.desc("t"), "word").limit(TOXIC_WORDS).collect()]
    else:
        toxic = []
    common = [r.word for r in uses.where("o > 0").orderBy(F.desc("o"), "word").limit(COMMON_WORDS).collect()]
    # Frequent words last: near matches are the cheapest.
    packed = [b"".join(xxh3_64_digest(bytes(w)) for w in reversed(ws)) for ws in ([w for w in common if w not in set(toxic)], toxic)]
    plain = Model(packed[0], packed[1], (0.0, 0.0, 0.0, 0.0))
    rows = _gains(sample.where("for_curve").select("text", "toxic"), plain).select("toxic", "gains.most", "gains.total").collect()
    found = np.array([(r.most, r.total) for r in rows], float).reshape(-1, 2)
    return Model(*packed, _calibrated(found, np.array([r.toxic for r in rows], float), toxic_share))


def _gains(docs: DataFrame, model: Model, name: str = "gains") -> DataFrame:
    """All columns of ``docs`` and a struct ``name`` of most, total and score, from ``text`` alone."""

    schema = with_column_type(docs.schema, name, "struct<most:long,total:long,score:double>")
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = Gains(model)
        for part in in_slices(batches, SLICE_BYTES):
            found = np.array([gains(t) for t in part.column(at).to_pylist()], np.int64).reshape(-1, 2)
            result = pa.StructArray.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(_score(model, found.astype(float)))], ["most", "total", "score"])
            yield pa.RecordBatch.from_arrays([*part.columns, result], names=[*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, held_out=lambda doc_id: hashed_below(doc_id, 3, 1)) -> DataFrame:
    """All columns of ``docs`` and a struct column (``toxicity``, or a variant that clashes with no
    column) of most, total and score.

    Only ``text`` enters a score; null and empty texts have no window and get the score of no gain.
    Without usable labels of both classes every score is the share of toxic labels. Labels other
    than 0 and 1 and null ids teach nothing; an id with both labels counts as toxic. Repeated rows
    score alike. Nothing is shuffled but the sample."""
    return _gains(docs, fit(docs, labels, held_out), clean_name(docs.columns, "toxicity"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with the columns of ``docs``."""
    scored = toxicity(docs, labels)
    return scored.where(F.col(f"{scored.columns[-1]}.score") < PREDICTED_FROM).select(*[F.col(f"`{c}`") for c in docs.columns])
