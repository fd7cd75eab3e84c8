"""Scaling of measure columns and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscape.functions.columns import column, known

_STATS = "_stats"


def _with_stats(df: DataFrame, stats: Sequence[Column]) -> DataFrame:
    """Adds one struct of global statistics; the aggregate has exactly one row."""
    return df.withColumn(_STATS, df.agg(F.struct(*stats).alias(_STATS)).scalar())


def standardise(df: DataFrame, columns: Sequence[str], *, suffix: str = "") -> DataFrame:
    """Mean 0 and sample deviation 1; a column of one value becomes 0.

    With a ``suffix`` the scaled values are added beside the columns.  The table is read twice, so hand in a materialised one if it is costly to compute.
    """
    stats = [F.avg(known(df, c)).alias(f"mean{i}") for i, c in enumerate(columns)] + [
        F.stddev_samp(known(df, c)).alias(f"dev{i}") for i, c in enumerate(columns)
    ]
    scaled = {}
    for i, c in enumerate(columns):
        mean, dev = F.col(_STATS)[f"mean{i}"], F.col(_STATS)[f"dev{i}"]
        flat = F.coalesce(dev, F.lit(0.0)) == 0
        value = known(df, c)
        scaled[c + suffix] = F.when(value.isNotNull() & flat, 0.0).otherwise(F.try_divide(value - mean, dev))
    return _with_stats(df, stats).withColumns(scaled).drop(_STATS)


def minmax_scale(df: DataFrame, columns: Sequence[str], *, suffix: str = "") -> DataFrame:
    """Rescale to 0..1; a column of one value becomes 0.  The table is read twice."""
    stats = [F.min(known(df, c)).alias(f"min{i}") for i, c in enumerate(columns)] + [
        F.max(known(df, c)).alias(f"max{i}") for i, c in enumerate(columns)
    ]
    scaled = {}
    for i, c in enumerate(columns):
        low, high = F.col(_STATS)[f"min{i}"], F.col(_STATS)[f"max{i}"]
        value = known(df, c)
        scaled[c + suffix] = F.when(value.isNotNull() & (high == low), 0.0).otherwise(
            F.try_divide(value - low, high - low)
        )
    return _with_stats(df, stats).withColumns(scaled).drop(_STATS)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Measures as one ML vector.  A missing value raises: choose a null policy first."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def scaled_features(
    df: DataFrame, columns: Sequence[str], *, raw: str = "features_raw", output: str = "features"
) -> DataFrame:
    """Assembled vector and its standardised form."""
    assembled = assemble(df, columns, raw)
    scaler = StandardScaler(inputCol=raw, outputCol=output, withMean=True, withStd=True)
    return scaler.fit(assembled).transform(assembled)


def as_array(columns: Sequence[str]) -> Column:
    """Measure columns as one array of doubles, the form the distance operators take."""
    return F.array(*[column(c).cast("double") for c in columns])
