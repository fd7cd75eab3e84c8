"""Long to wide and back, row totals and ordered listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscape.functions.columns import column, row_total


def category_values(categories: DataFrame, name: str) -> list[str]:
    """The distinct categories in order, for use as pivot columns.

    Best asked of the small category table rather than of the facts.  More values than
    a pivot allows raise here instead of giving a table of unusable width.
    """
    limit = int(categories.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = (
        categories.select(column(name).alias("v")).filter(F.col("v").isNotNull()).distinct().limit(limit + 1).collect()
    )
    if len(rows) > limit:
        raise ValueError(f"{name} has more than {limit} values")
    return sorted(r["v"] for r in rows)


def to_wide(
    df: DataFrame,
    entity: str,
    category: str,
    measure: str,
    *,
    values: Sequence[str] | None = None,
    fill: int | None = 0,
    other: str | None = None,
) -> DataFrame:
    """One row per entity, one summed column per category, gaps filled.

    With ``values`` no extra job is needed to find the categories and the column order
    is fixed.  A row of another category, or of none, raises, unless ``other`` names a column
    for the sum of such rows.  Whole numbers are summed as long, decimals as decimals.

    Rows are summed per entity and category first, so the conditional sums of the second step see one
    row per pair, for any number of categories.
    """
    kind = df.schema[measure].dataType
    amount = column(measure)
    if not isinstance(kind, T.DecimalType):
        amount = amount.cast("long" if isinstance(kind, T.IntegralType) else "double")
    found = list(values) if values is not None else category_values(df, category)
    name, total = F.col("_category"), F.col("_sum")
    pairs = df.groupBy(column(entity), column(category).alias("_category")).agg(F.sum(amount).alias("_sum"))
    listed = F.coalesce(name.isin(found), F.lit(False))
    if other is None and values is not None:
        outside = F.raise_error(F.concat(F.lit("category not listed: "), F.coalesce(name.cast("string"), F.lit("null"))))
        pairs = pairs.withColumn("_category", F.when(listed, name).otherwise(outside.cast(pairs.schema["_category"].dataType)))
    sums = [F.sum(F.when(name == v, total)).alias(v) for v in found]
    if other is not None:
        sums.append(F.sum(F.when(~listed, total)).alias(other))
    if fill is not None:
        filled = [*found, *([other] if other is not None else [])]
        sums = [F.coalesce(s, F.lit(fill).cast(pairs.schema["_sum"].dataType)).alias(n) for s, n in zip(sums, filled)]
    return pairs.groupBy(column(entity)).agg(*sums)


def to_long(
    df: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    *,
    category: str = "category",
    measure: str = "measure",
) -> DataFrame:
    """One row per entity and measure column; nulls are kept."""
    ids = [keys] if isinstance(keys, str) else list(keys)
    return df.unpivot([column(c) for c in ids], [column(c) for c in columns], category, measure)


def with_total(df: DataFrame, columns: Sequence[str], name: str = "total") -> DataFrame:
    """Adds the row total.  Any null makes it null, so fill missing values first."""
    return df.withColumn(name, row_total(df, list(columns)))


def top_by(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The ``n`` largest rows, ties broken by key; each task keeps only ``n`` rows."""
    return df.orderBy(column(value).desc(), column(key)).limit(n)


def members_in_order(df: DataFrame, cluster: str, entity: str) -> DataFrame:
    """All members of all clusters in one global sort, whatever ids the data holds."""
    return df.select(column(cluster), column(entity)).orderBy(column(cluster), column(entity))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select with aliases: ``{"new name": "column"}``."""
    return df.select(*[column(c).alias(n) for n, c in names.items()])


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.withColumns(new)
