"""The training-data pipeline: five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but
the last return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import decontamination, line_dedup, near_dedup, packing, quality_rules
from ledgerlark.llm.common import stored, table
from ledgerlark.llm.queries import TOKENIZER


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that break a quality rule."""
    return quality_rules.keep_good(docs)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated lines out of the texts; ``n_chars`` follows the text."""
    left = line_dedup.dedup(docs).withColumn("n_chars", F.length("text").cast("long"))
    return left.select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    return near_dedup.one_of_each(docs)


def unleaked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_documents),
    ("line_dedup", unrepeated_lines),
    ("minhash_near_dedup", distinct_documents),
    ("benchmark_decontamination", unleaked_documents),
    ("best_fit_packing", packed_sequences),
]

#: Tokens and verified similarity components have no SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
