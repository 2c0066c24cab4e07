"""Training-text pipeline over ``documents``: five operators one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage
before it kept; its result is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``.

Defined results: a null or empty text fails the base rules and goes with the first
stage; texts of any length are taken whole; of equal texts, and of each component
of near copies, the row with the smallest id stays (null ids last, then the smaller hash of
the text), and rows that repeat id and text are one from the second stage on; a null language,
source or length passes through, a null source being a source of its own; an empty table
gives an empty result; extra columns pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from castline.llm import byte_bpe, exact_dedup, mixing, ngram_join, quality
from castline.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the log-likelihood ratio."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.distinct_kept(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: a similarity of 80 percent of their sets of five words."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, small sources more often, in the order of the mix."""
    return mixing.remix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The byte-level BPE ids of each use of a document, and the digests of ids and decoded text."""
    return byte_bpe.encode(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("mix_sources", mix),
    ("byte_bpe", tokens),
]

#: SQL expresses neither the scored rules nor the tokenizer; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
