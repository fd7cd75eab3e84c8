"""Descriptive statistics of measure columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallyscape.functions.columns import column, known_as_is, known_values
from tallyscape.operators.quality import _per_column
from tallyscape.operators.quantiles import quantiles
from tallyscape.session import with_package
from tallyscape.sources.files import footer_session

BLOCK = 1024  # columns whose pairs a task sums up at once
_CELLS = 1 << 20  # values of a batch multiplied at a time
_LOOKED_AT = 1000  # rows that the differences are taken from; they change no more than the rounding
_FLAT = 1e-13  # share of the squares that a spread has by rounding alone
_SUMS = ("x", "y", "xx", "yy", "xy")


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value per column, all in one pass, in the columns' common type."""
    return _per_column(
        df,
        columns,
        {
            "min": {c: F.min(known_as_is(df, c)) for c in columns},
            "max": {c: F.max(known_as_is(df, c)) for c in columns},
        },
    )


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """column_name, rows, present, least, greatest of whole-number columns of a Parquet table, from its footers.

    Counts read no row, whatever the size of the table, nor do the bounds of columns without nulls.  A column with nulls
    is read for its bounds, as a part of a file that holds nulls only has none in its footer; one without any value has none at all.
    Columns of other types raise: footers cut long texts and know no NaN.
    """
    table = footer_session(spark).read.parquet(path)
    other = [c for c in columns if not isinstance(table.schema[c].dataType, IntegralType)]
    if other:
        raise ValueError(f"not whole numbers: {', '.join(other)}")
    counts = table.agg(F.count(F.lit(1)), *[F.count(column(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    n, *present = (v or 0 for v in counts)  # without any file a count from footers is null

    def bounds(rows: DataFrame, some: Sequence[int]) -> DataFrame:
        both = rows.agg(*[f(column(columns[i])).alias(f"{f.__name__}{i}") for i in some for f in (F.min, F.max)])
        packed = [
            F.struct(
                F.lit(columns[i]).alias("column_name"), F.lit(n).cast("long").alias("rows"), F.lit(present[i]).cast("long").alias("present"),
                F.col(f"min{i}").cast("long").alias("least"), F.col(f"max{i}").cast("long").alias("greatest"),
            )
            for i in some
        ]
        return both.select(F.inline(F.array(*packed)))

    whole = [i for i in range(len(columns)) if present[i] == n]
    gaps = [i for i in range(len(columns)) if present[i] < n]
    parts = [bounds(rows, some) for rows, some in ((table, whole), (spark.read.parquet(path), gaps)) if some]
    return reduce(DataFrame.unionByName, parts)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max, one row per column."""
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75])
    per_quartile = {
        label: {c: F.any_value(F.lit(quartiles[c][i]).cast("double")) for c in columns}
        for i, label in enumerate(["q25", "q50", "q75"])
    }
    value = {c: F.col(f"v{i}") for i, c in enumerate(columns)}
    return _per_column(
        known_values(df, columns),
        columns,
        {
            "count": {c: F.count(v) for c, v in value.items()},
            "mean": {c: F.avg(v) for c, v in value.items()},
            "std": {c: F.stddev_samp(v) for c, v in value.items()},
            "min": {c: F.min(v) for c, v in value.items()},
            **per_quartile,
            "max": {c: F.max(v) for c, v in value.items()},
        },
    )


def correlations(df: DataFrame, columns: Sequence[str], *, block: int = BLOCK) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are known.

    Every task multiplies its rows, as matrices of values and of what is known, and hands on six sums for each
    pair; these are added in a shuffle by pair.  One pass up to ``block`` columns; more columns go in pairs of
    blocks, each in a pass of its own, so a task holds at most ``block`` squared pairs.  A column of one value (among
    the rows of the pair) has no correlation: null.
    """
    values = known_values(df, columns)
    # Any value near the column's own serves: differences from it keep the sums from cancelling out.
    some = values.limit(_LOOKED_AT).agg(*[F.min(f"v{i}").alias(f"v{i}") for i in range(len(columns))]).first()
    shift = np.array([some[f"v{i}"] or 0.0 for i in range(len(columns))])
    starts = range(0, len(columns), block)
    parts = []
    for a, b in combinations_with_replacement(starts, 2):
        left, right = (list(range(s, min(s + block, len(columns)))) for s in (a, b))
        wanted = values.select(*[f"v{i}" for i in sorted({*left, *right})])
        sums = ", ".join(f"{c} double" for c in _SUMS)
        parts.append(with_package(wanted).mapInArrow(_products(left, right, shift), f"i int, j int, n long, {sums}"))
    pairs = _added(reduce(DataFrame.unionByName, parts)) if len(columns) > 1 else None
    if pairs is None:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, correlation double")
    n, x, y, xx, yy, xy = (F.col(c) for c in ("n", *_SUMS))
    spread_x, spread_y = xx - F.try_divide(x * x, n), yy - F.try_divide(y * y, n)
    flat = (spread_x <= _FLAT * xx) | (spread_y <= _FLAT * yy)
    found = F.try_divide(xy - F.try_divide(x * y, n), F.sqrt(spread_x) * F.sqrt(spread_y))
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select(
        names[F.col("i")].alias("column_a"), names[F.col("j")].alias("column_b"), F.when(~flat, found).alias("correlation")
    )


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", *_SUMS)])


def _products(left: list[int], right: list[int], shift: np.ndarray):
    """Sums over the rows of a task for every pair i < j of a left and a right column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(left), len(right)))
        for batch in batches:
            step = max(1, _CELLS // batch.num_columns)
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)

                def side(numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
                    read = [part.column(part.schema.get_field_index(f"v{i}")) for i in numbers]
                    known = np.array([c.is_valid().to_numpy(zero_copy_only=False) for c in read], float)
                    x = np.array([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in read])
                    return (x - shift[numbers][:, None]) * known, known

                (x, known_x), (y, known_y) = side(left), side(right)
                total += [known_x @ known_y.T, x @ known_y.T, known_x @ y.T, x**2 @ known_y.T, known_x @ (y**2).T, x @ y.T]
        i, j = np.meshgrid(left, right, indexing="ij")
        upper = i < j
        yield pa.RecordBatch.from_arrays(
            [pa.array(i[upper].astype(np.int32)), pa.array(j[upper].astype(np.int32)), pa.array(total[0][upper].astype(np.int64))]
            + [pa.array(t[upper]) for t in total[1:]],
            ["i", "j", "n", *_SUMS],
        )

    return run
