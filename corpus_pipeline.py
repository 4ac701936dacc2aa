"""Training-corpus pipeline: language ID, exact dedup, near dedup, personal
data, packing. Every stage but the last returns the columns of ``documents``.

In every stage null and repeated ids are rows like others, a null text counts
as empty (the first stage rejects it), texts of any length are processed whole,
rows that repeat are copies of each other (the second stage keeps one), extra
columns are carried through whatever their names, and an empty table gives an
empty table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheetlake.llm.common import written
from sheetlake.llm.exact_dedup import drop_exact_duplicates
from sheetlake.llm.langid import keep_identified
from sheetlake.llm.minhash import drop_near_duplicates
from sheetlake.llm.packing import pack
from sheetlake.llm.pii import replace_personal_data

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without an identifiable language (no text or no letter);
    the others carry the language that the network finds in ``lang``, where it
    is sure (score 0.5 or more), else their own. Without labelled rows to learn
    from, nothing but texts without a letter goes."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per text, A-Z lower-cased; the largest id stays."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of near duplicates (five words, 0.8 or more)."""
    return drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates in every text."""
    return replace_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, without the token ids."""
    return pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: language ID, MinHash and packing have no SQL form; tests/llm checks run() against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
