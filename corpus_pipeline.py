"""The corpus pipeline: documents through five operators, from raw rows to tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again before the next. All but the last return the columns of ``documents``.

Defined results, for every stage: an empty table gives an empty result with the same columns; a null text counts as the empty text, and the base rule rejects it; null
and repeated doc_ids are rows like any other; very long texts are treated whole; columns beyond those of ``documents``, of whatever name, pass unchanged through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from premia.llm import bpe, exact, mixing, quality, simhash
from premia.llm.common import documents, ship, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the thresholds of their language and source. Repeated rows are judged alike; a value at its threshold passes."""
    ship(spark)
    return quality.kept_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the greatest doc_id (null last), of equal ones that with the greatest locator."""
    ship(spark)
    return exact.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (five-word shingles, similarity 0.8): the least doc_id (null first), of equal ones that with the least locator."""
    ship(spark)
    return simhash.kept_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: 0, 1 or 2 times, the same in a repeated run."""
    ship(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document: counts and digests of the ids and of the decoded text. Repeated rows get equal digests."""
    ship(spark)
    return bpe.encode_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("tokens", tokens),
]

#: Near copies, balanced sampling and tokens are beyond SQL; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
