"""A training-corpus pipeline: every stage works on the rows its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import fm_decontam, hash_mix, pigeon_simhash, zstd_toxicity
from roadpulse.llm.common import prepared, stored, table
from roadpulse.llm.queries import token_rows


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents predicted toxic go."""
    return zstd_toxicity.without_toxic(docs, table(prepared(spark), sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of every group of linked documents the one with the smallest id stays."""
    prepared(spark)
    return pigeon_simhash.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold benchmark passages go."""
    return fm_decontam.without_contaminated(docs, table(prepared(spark), sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: each document as often as the mix takes it."""
    prepared(spark)
    return hash_mix.repeat_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token files in ascending order of the id, read back."""
    prepared(spark)
    return token_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token output", write_tokens),
]

# Dictionaries, XXH64 with a seed and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
