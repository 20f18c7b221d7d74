"""The corpus pipeline: documents in, directly addressable token ids out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import decontaminate, language, mixing, simhash, token_store
from skyledger.llm.common import file_order, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Null and blank texts go, rows that repeat
    stay; an empty table stays empty, here and in every stage."""
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id. Null
    and blank texts are one group; documents without an id stay."""
    return simhash.keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and blank texts hold none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, each whole, in mixed order. Those without
    a word are not taken; those without a source are a source."""
    return mixing.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' places in the token files, read back from these. Documents stand in
    the order in which the stage before has written them; a null text is empty."""
    segments = token_store.write_segments(docs, order=file_order(docs))
    return token_store.read_documents(segments)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# Language models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
