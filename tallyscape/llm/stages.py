"""The stages of the text pipeline.  Each takes (spark, docs, sf_dir) and returns documents that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyscape.llm import bpe, exact_dedup, langid, mixing, ngram_join
from tallyscape.llm.common import unused
from tallyscape.llm.queries import public_vocabulary

#: A text is rejected if it has no letter, or no language reaches this mean probability.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognised language."""
    net = langid.learn(docs.filter(~langid.held_out("doc_id")), "text", "lang", F.col("doc_id"))
    lang, score = (unused(docs, name) for name in ("_lang", "_score"))
    judged = langid.predict(docs, net, lang_pred=lang, score=score)
    return judged.filter((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).drop(lang, score)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return ngram_join.drop_similar(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken; those it takes nothing of go."""
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    ranks, pattern = public_vocabulary()
    own = ("n_tokens", "ids", "round_trip")  # columns of these names are replaced
    coded = bpe.encode_decode(docs.drop(*own), ranks, pattern, round_trip="round_trip")
    return coded.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in own],
        F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        "ids",
        "round_trip",
    )
