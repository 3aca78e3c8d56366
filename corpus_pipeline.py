"""The corpus pipeline: quality rules, line dedup, near duplicates, decontamination, BPE.

Each stage takes what its predecessor kept; all but the last return the columns of the
documents that they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import bpe_round_trip
from quire.llm.common import materialize, read
from quire.llm.decontaminate import decontaminate
from quire.llm.line_dedup import line_dedup
from quire.llm.ngram_join import ngram_join
from quire.llm.quality_rules import quality_rules
from quire.operators.skew import join_small

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return quality_rules(docs).filter("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds; n_chars follows the text."""
    return _counted(line_dedup(docs)).select(*docs.columns)


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (5 words, similarity 0.8): the one with
    the smallest id. Rows of one id that are repeated stay as they are."""
    gone = ngram_join(docs).filter("component_id <> doc_id").select("doc_id").distinct()
    return join_small(docs, gone, "doc_id", "left_anti")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids; round_trip tells whether they decode to the text."""
    coded = bpe_round_trip(docs, VOCABULARY)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", leaks),
    ("bpe", tokens),
]

#: Perplexity, merges and components have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
