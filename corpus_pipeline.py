"""A training corpus from raw documents: five stages, each a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelops.llm import bitplanes, ecoc_language, jaccard_orders, soft_mix, suffix_automaton
from panelops.llm.common import read, small_batches
from panelops.llm.queries import MIX_WEIGHTS, TOKENIZER
from panelops.staging import scratch_path

#: Word shingles of the stage "near duplicates", and the Jaccard similarity in percent from which copies go.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    small_batches(spark)
    return ecoc_language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    small_batches(spark)
    return jaccard_orders.keep_one(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    small_batches(spark)
    return suffix_automaton.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate asks for."""
    return soft_mix.apply(docs, soft_mix.domains_of(read(spark, sf_dir, "labels")), MIX_WEIGHTS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what they hold of each document."""
    small_batches(spark)
    path = scratch_path(spark, "ids")
    bitplanes.write_ids(docs, path, TOKENIZER)
    return bitplanes.read_documents(spark, path)


STAGES = [
    ("language ID", language),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing to target weights", mixture),
    ("token files", token_files),
]
#: Language prediction, mixing and tokenizing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage's table is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
