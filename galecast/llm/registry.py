"""The registered queries of this subpackage: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galecast.llm import conversations, decontam, langid, lm, merkle, mix, packing, quality, shard, simhash, substrings, tokens, urls
from galecast.llm.oracle import ORACLE
from galecast.llm.text import documents


def op1_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted_documents(documents(spark, sf_dir))


def op2_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm.scored_documents(documents(spark, sf_dir))
    return scores.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"), "n_backed_off")


def op3_template_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.checked_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op4_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded_documents(documents(spark, sf_dir))


def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_quality(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op6_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mixed_documents(documents(spark, sf_dir))


def op7_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.sharded_documents(documents(spark, sf_dir))


def op8_deletion_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.with_verdicts(documents(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op10_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_documents(documents(spark, sf_dir))


def op11_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_documents(documents(spark, sf_dir))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir))


def op13_streamed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_conversations(documents(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_output_codes, op2_stupid_backoff, op3_template_windows, op4_addressable_codes, op5_compression_bands, op6_cube_mix, op7_interleaved_shards, op8_deletion_variants, op9_url_automaton, op10_block_anchors, op11_merkle_proofs, op12_best_fit_packing, op13_streamed_repair)
}

__all__ = ["ORACLE", "QUERIES"]
