"""The text operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyscape.llm import bpe, column_bwt, credentials, embedding_dedup, exact_dedup, langid, mixing, ngram_join, pii, prefix_trie, spelling, substring_dedup, vantage
from tallyscape.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def public_vocabulary(name: str = VOCABULARY) -> tuple[dict[bytes, int], str]:
    """Ranks and split pattern of a public tokenizer installed beside this library."""
    import public_tokenizers

    return bpe.read_ranks(Path(public_tokenizers.path(name)).read_bytes().splitlines()), public_tokenizers.PATTERN


#: Surrogates are the same wherever this key is; a user passes a secret one.
DEMO_KEY = "surrogates-of-the-given-tables"


def op1_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.surrogates(table(spark, folder, "documents").select("doc_id", "text"), DEMO_KEY)


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source")


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.drop_repeats(table(spark, folder, "documents"))


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_vocabulary()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, ranks, pattern)
    return coded.select(
        "doc_id",
        F.expr("length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op8_credentials(spark: SparkSession, folder: str) -> DataFrame:
    return credentials.report(table(spark, folder, "documents"))


def op9_suffix_columns(spark: SparkSession, folder: str) -> DataFrame:
    return column_bwt.drop_repeats(table(spark, folder, "documents"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.copies(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.words(table(spark, folder, "documents"), drop_every=31)
    return spelling.variants(words)


def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return vantage.nearest(table(spark, folder, "embeddings"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.rebuilt(table(spark, folder, "conversations"))
    return prefix_trie.nodes(turns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pii_surrogates,
        op2_ngram_jaccard_join,
        op3_mixing,
        op4_substring_dedup,
        op5_byte_bpe,
        op6_embedding_dedup,
        op7_language_id,
        op8_credentials,
        op9_suffix_columns,
        op10_exact_dedup,
        op11_spelling_variants,
        op12_nearest_neighbours,
        op13_prefix_trie,
    )
}
