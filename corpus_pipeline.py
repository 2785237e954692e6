"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from galecast.llm import decontam, mix, quality, simhash, tokens
from galecast.llm.shared import ship, stored
from galecast.llm.text import documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or leave their compression band go; see galecast.llm.quality."""
    ship(spark)
    return quality.rejected_removed(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints stays, that with the least doc_id; see galecast.llm.simhash."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; see galecast.llm.decontam."""
    return decontam.contaminated_removed(docs, documents(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as often as the balanced sample of its source takes it, from 0 to 2 times; see galecast.llm.mix."""
    ship(spark)
    return mix.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, read back from the token table; see galecast.llm.tokens."""
    ship(spark)
    return tokens.encoded_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

#: Compression, the vocabulary and the balanced sample can't be put in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each stage's result stored before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
