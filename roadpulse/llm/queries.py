"""The operators over the given tables, one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import (
    fm_decontam, hash_mix, histogram_shards, hyper_lang, line_dedup, link_filter, pigeon_simhash, prefix_trie, quality_bayes,
    token_alignment, token_files, tput_search, zstd_toxicity,
)
from roadpulse.llm.common import hashed_below, prepared, shared_folder, table

END_ID = 2
SHARDS = 40
QUERY_STEP = 50
TOP = 5


def byte_bpe() -> str:
    """Where the public vocabulary file is; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_bpe() -> str:
    """Where the public sentencepiece model is."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def token_rows(docs: DataFrame) -> DataFrame:
    """Writes the token files of ``docs`` and reads them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(docs, folder, byte_bpe(), END_ID)
    return token_files.read_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rows(table(spark, sf_dir, "documents"))


def op2_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources, paths the languages below them: documents carry no address."""
    docs = table(spark, sf_dir, "documents")
    scored = quality_bayes.quality(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return scored.withColumn("held_out", hashed_below(F.col("doc_id"), 3, 1)).withColumn("predicted", F.col("keep").cast("int"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = histogram_shards.shard(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op5_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = fm_decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", F.size("contamination.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "contamination.items"), 256).alias("items_sha256"), "contamination.contaminated")


def op6_hash_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_mix.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_hyper_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = hyper_lang.languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return judged.select("doc_id", hashed_below(F.col("doc_id"), 4, 2).alias("held_out"),
                         F.col("language.lang").alias("lang_pred"), "language.score")


def op8_tput_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = tput_search.scaled(table(spark, sf_dir, "embeddings"))
    return tput_search.search(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0), TOP)


def op9_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = zstd_toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", hashed_below(F.col("doc_id"), 3, 1).alias("held_out"), "toxicity.score",
                         (F.col("toxicity.score") >= zstd_toxicity.PREDICTED_FROM).cast("int").alias("predicted"))


def op10_pigeon_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pigeon_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.alignments(table(spark, sf_dir, "documents"), byte_bpe(), piece_bpe(), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def _configured(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(prepared(spark), sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator."""
    return {q.__name__: _configured(q) for q in (
        op1_token_files, op2_quality_bayes, op3_line_dedup, op4_histogram_shards, op5_fm_decontam, op6_hash_mix,
        op7_hyper_lang, op8_tput_search, op9_zstd_toxicity, op10_pigeon_simhash,
        op11_token_alignment, op12_link_filter, op13_prefix_trie,
    )}
