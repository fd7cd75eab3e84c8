"""Summaries of tables that can be stored, compared and merged: digests and distinct counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.functions.columns import column

_HALF = 15  # hex digits, 60 bits, of a row's digest in each sum


def _row_digest(columns: Sequence[str]) -> Column:
    """MD5 of the row: each value as its length and text, so neighbours cannot run together; null is ``-``."""
    texts = [column(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def table_digest(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``by``, rows, digest: equal for equal sets of rows, whatever their order, files and partitions.

    Repeated rows count as often as they occur.  Columns are taken in the order of their names, unless given.  Two
    sums over row digests are added in the map tasks, so a hot group is no burden; null groups are groups.  Without
    ``by`` an empty table has 0 rows and a digest; with it, it has no groups.  Times and doubles are compared as
    Spark writes them as text.
    """
    chosen = sorted(set(df.columns) - set(by)) if columns is None else list(columns)
    if not chosen:
        raise ValueError("no column to compare")
    rows = df.select(*[column(c).alias(c) for c in by], _row_digest(chosen).alias("_digest"))
    half = lambda first: F.conv(F.substring("_digest", first, _HALF), 16, 10).cast("decimal(20,0)")
    sums = rows.groupBy(*[column(c) for c in by]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(half(1)), F.lit(0)).cast("string").alias("_a"),
        F.coalesce(F.sum(half(1 + _HALF)), F.lit(0)).cast("string").alias("_b"),
    )
    digest = F.md5(F.concat_ws(":", F.col("rows").cast("string"), "_a", "_b").cast("binary"))
    return sums.select(*[column(c) for c in by], "rows", digest.alias("digest"))


def changed_groups(before: DataFrame, after: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by`` of the groups whose digests differ, and of those that only one side has."""
    left = before.select(*[column(c).alias(c) for c in by], F.col("rows").alias("rows_before"), F.col("digest").alias("_x"))
    right = after.select(*[column(c).alias(f"_{c}") for c in by], F.col("rows").alias("rows_after"), F.col("digest").alias("_y"))
    same = F.lit(True)
    for c in by:
        same = same & column(c).eqNullSafe(column(f"_{c}"))
    names = [F.coalesce(column(c), column(f"_{c}")).alias(c) for c in by]
    return left.join(right, same, "full").filter(~F.col("_x").eqNullSafe(F.col("_y"))).select(*names, "rows_before", "rows_after")


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, *, log_size: int = 12) -> DataFrame:
    """``keys``, sketch: one mergeable sketch of distinct values per group, to be stored beside the facts.

    Nulls are not counted.  Of 2^``log_size`` registers, so at most some KB a group; the relative standard error of a
    count is about 0.83 / sqrt(2^log_size).
    """
    return df.groupBy(*[column(c) for c in keys]).agg(F.hll_sketch_agg(column(value), log_size).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys``, distinct_values: stored sketches merged to coarser groups, without reading the facts again."""
    merged = sketches.groupBy(*[column(c) for c in keys]).agg(F.hll_union_agg("sketch", True).alias("_all"))
    return merged.select(*[column(c) for c in keys], F.hll_sketch_estimate("_all").alias("distinct_values"))
