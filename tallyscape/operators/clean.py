"""Filters, missing-value policies and duplicate removal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.functions.columns import column, is_missing, known
from tallyscape.functions.text import clean_name
from tallyscape.operators.quantiles import quantiles


def with_clean_names(df: DataFrame, name: str, **options: bool) -> DataFrame:
    return df.withColumn(name, clean_name(column(name), **options))


def is_valid_key(c: Column, reject: Sequence[str] = ()) -> Column:
    """Not null, not empty once trimmed, and not one of the rejected labels; never null itself."""
    usable = c.isNotNull() & (F.trim(c) != "")
    if reject:
        usable = usable & ~c.isin(*reject)
    return F.coalesce(usable, F.lit(False))


def valid_keys(
    df: DataFrame,
    name: str,
    *,
    reject: Sequence[str] = (),
    zero_rows_of: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with a usable name.  ``zero_rows_of`` also drops rows where all these measures are 0."""
    kept = df.filter(is_valid_key(column(name), reject))
    if zero_rows_of:
        nonzero = [F.coalesce(column(c) != 0, F.lit(True)) for c in zero_rows_of]
        kept = kept.filter(F.exists(F.array(*nonzero), lambda x: x))
    return kept


def fill_missing(df: DataFrame, columns: Sequence[str], value: float | int | str = 0) -> DataFrame:
    """Policy one: a missing measure means ``value``; NaN counts as missing."""
    return df.fillna(value, subset=list(columns))


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Policy two: a row with any missing value is dropped."""
    return df.dropna("any", subset=list(columns) if columns is not None else None)


def _mode_per_column(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value of each column; a tie goes to the smaller value.

    One grouping set per column counts the values of all columns in one pass.  Counts
    are combined before the shuffle, so a value held by most rows costs each task one
    partial count.  The driver receives one value per column.
    """
    known_only = df.select(*[F.when(~is_missing(df, c), column(c)).alias(f"v{i}") for i, c in enumerate(columns)])
    values = [F.col(f"v{i}") for i in range(len(columns))]
    counts = known_only.groupingSets([[v] for v in values], *values).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(
        *[
            F.min(F.when(v.isNotNull(), F.struct((-F.col("n")).alias("order"), v.alias("value")))).alias(f"b{i}")
            for i, v in enumerate(values)
        ]
    ).first()
    return {c: best[f"b{i}"]["value"] for i, c in enumerate(columns) if best[f"b{i}"] is not None}


def impute(df: DataFrame, strategy: str, columns: Sequence[str]) -> DataFrame:
    """Replace missing values by the column's mean, exact median or mode.

    A column without any value is left as it is.  Means and medians are doubles, so the
    filled column is a double too; a mode keeps the type.
    """
    columns = list(columns)
    if strategy == "mean":
        row = df.agg(*[F.avg(known(df, c)).alias(c) for c in columns]).first()
        fill: Mapping[str, object] = {c: row[c] for c in columns if row[c] is not None}
    elif strategy == "median":
        fill = {c: v[0] for c, v in quantiles(df, columns, [0.5]).items() if v[0] is not None}
    elif strategy == "mode":
        fill = _mode_per_column(df, columns)
    else:
        raise ValueError(f"unknown strategy {strategy!r}: use mean, median or mode")
    filled = {}
    for name, value in fill.items():
        present = column(name) if strategy == "mode" else column(name).cast("double")
        filled[name] = F.when(is_missing(df, name), F.lit(value)).otherwise(present)
    return df.withColumns(filled)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all, found in one pass."""
    row = df.agg(*[F.count(F.when(~is_missing(df, c), 1)).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return df.drop(*[column(c) for i, c in enumerate(df.columns) if row[f"n{i}"] == 0])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(column(name)).distinct()


def keep_values(df: DataFrame, name: str, values: Sequence[object] | DataFrame) -> DataFrame:
    """Rows whose ``name`` is in a short list, or in the same column of another table."""
    if isinstance(values, DataFrame):
        return df.join(values.select(column(name)), name, "left_semi")
    return df.filter(column(name).isin(*values))


def keep_first_values(df: DataFrame, name: str, n: int) -> DataFrame:
    """Rows whose ``name`` is among its ``n`` smallest distinct values."""
    first = distinct_values(df.filter(column(name).isNotNull()), name).orderBy(column(name)).limit(n)
    return df.join(first, name, "left_semi")


def preview(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in a stated order: a distributed table has no order of its own."""
    if not order_by:
        raise ValueError("preview needs an order")
    return df.orderBy(*order_by).limit(n)
