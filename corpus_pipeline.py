"""The text pipeline: five stages, each applied to what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyscape.llm import stages
from tallyscape.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", stages.language_id),
    ("exact_dedup", stages.exact_dedup_stage),
    ("ngram_jaccard_join", stages.near_dedup),
    ("mixing", stages.mixing_stage),
    ("byte_bpe", stages.byte_bpe),
]

#: A trained classifier, a keyed shuffle and a tokenizer are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
