"""Corpus pipeline: STAGES in order, each written as Parquet and reread as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, langid, minhash, mixing, token_blocks
from tidewatch.llm.catalog import tokenizer_file
from tidewatch.session import configure, stage_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the recurrent network recognises."""
    return langid.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.deduplicated(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; documents on the edge of a block with the words taken."""
    return mixing.mix_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: place, length and checksum of every document's ids."""
    return token_blocks.tokens_round_trip(docs, tokenizer_file())


STAGES = [
    ("identify_languages", identify_languages),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_benchmark_copies", drop_benchmark_copies),
    ("mix_sources", mix_sources),
    ("write_token_files", write_token_files),
]

#: Language identification and tokens cannot be said in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's output is kept in the shared folder."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        path = stage_path(spark, f"corpus-{name}-{uuid.uuid4().hex[:8]}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
