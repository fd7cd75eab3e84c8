"""Choosing columns and building the small expressions used everywhere."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def measure_columns(df: DataFrame, keys: str | list[str]) -> list[str]:
    """Numeric columns that are not keys, picked by type rather than by position."""
    skip = {keys} if isinstance(keys, str) else set(keys)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and isinstance(f.dataType, T.NumericType)
    ]


def quoted(name: str) -> str:
    """Backquote a column name so that blanks and dots in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN where the type has one (``isnan(null)`` is false)."""
    c = column(name)
    return (c.isNull() | F.isnan(c)) if is_fractional(df, name) else c.isNull()


def known(df: DataFrame, name: str) -> Column:
    """The value as a double, with NaN turned into null so aggregates skip both."""
    return F.when(~is_missing(df, name), column(name).cast("double"))


def known_as_is(df: DataFrame, name: str) -> Column:
    """The value in its own type, with NaN turned into null."""
    return F.when(~is_missing(df, name), column(name))


def known_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns as ``known`` doubles named v0, v1, ..., computed once for all later uses."""
    values = [known(df, c).alias(f"v{i}") for i, c in enumerate(columns)]
    return df.select(*[column(k) for k in keep], *values)


def row_total(df: DataFrame, columns: list[str]) -> Column:
    """Row-wise sum; whole numbers add up as long so that no int can overflow."""
    if not columns:
        raise ValueError("row_total needs at least one column")
    kinds = [df.schema[c].dataType for c in columns]
    if any(isinstance(k, T.DecimalType) for k in kinds) and not any(isinstance(k, T.FractionalType) and not isinstance(k, T.DecimalType) for k in kinds):
        return reduce(lambda a, b: a + b, [column(c) for c in columns])  # decimals stay exact
    wide = "long" if all(isinstance(k, T.IntegralType) for k in kinds) else "double"
    return reduce(lambda a, b: a + b, [column(c).cast(wide) for c in columns])


def with_default(c: Column, default: object) -> Column:
    return F.coalesce(c, F.lit(default))
