"""Profiles and data-quality checks.  Each check reads its input once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.functions.columns import column, is_missing, known
from tallyscape.operators.clean import is_valid_key
from tallyscape.operators.quantiles import quantiles


def _per_column(df: DataFrame, columns: Sequence[str], stats: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One aggregate over all columns, then one row per column: ``stats[name][column]``."""
    packed = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[stats[s][c].alias(s) for s in stats])
            for c in columns
        ]
    )
    return df.agg(packed.alias("rows")).select(F.inline("rows"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled row count per table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    out = counted[0]
    for more in counted[1:]:
        out = out.unionByName(more)
    return out


def existing_table_counts(spark, names: Sequence[str]) -> DataFrame:
    """As ``table_counts``, for those of the names that the catalogue knows."""
    present = {n: spark.table(n) for n in sorted(set(names)) if spark.catalog.tableExists(n)}
    if not present:
        return spark.createDataFrame([], "table_name string, record_count long")
    return table_counts(present)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing (null or NaN) values per column."""
    counts = {c: F.count(F.when(is_missing(df, c), 1)) for c in columns}
    return _per_column(df, columns, {"missing": counts})


def profile(df: DataFrame) -> DataFrame:
    """Name, position, type, row count and non-null count of every column."""
    facts = {
        "position": {c: F.any_value(F.lit(i)) for i, c in enumerate(df.columns)},
        "type": {f.name: F.any_value(F.lit(f.dataType.simpleString())) for f in df.schema.fields},
        "rows": {c: F.count(F.lit(1)) for c in df.columns},
        "present": {c: F.count(F.when(~is_missing(df, c), 1)) for c in df.columns},
    }
    return _per_column(df, df.columns, facts)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Extra copies of rows: a row seen three times counts two."""
    copies = df.groupBy(*[column(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def missing_names(df: DataFrame, name: str, *, reject: Sequence[str] = ()) -> DataFrame:
    """How many rows have no usable name."""
    return df.agg(F.count(F.when(~is_valid_key(column(name), reject), 1)).alias("missing_names"))


def numeric_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, how many counts are negative and how many are missing."""
    negative = {c: F.count(F.when(known(df, c) < 0, 1)) for c in columns}
    missing = {c: F.count(F.when(is_missing(df, c), 1)) for c in columns}
    return _per_column(df, columns, {"negative": negative, "missing": missing})


def _flag_outside(
    df: DataFrame, keys: Sequence[str], fences: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """Long rows of the values outside their column's fences; a null fence flags nothing."""
    checks = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                known(df, c).alias("value"),
                F.lit(low).cast("double").alias("lower"),
                F.lit(high).cast("double").alias("upper"),
            )
            for c, (low, high) in fences.items()
        ]
    )
    outside = F.filter(checks, lambda s: (s["value"] < s["lower"]) | (s["value"] > s["upper"]))
    return df.select(*[column(k) for k in keys], F.inline(outside))


def outliers_iqr(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *, factor: float = 1.5) -> DataFrame:
    """Values below Q1 - factor*IQR or above Q3 + factor*IQR of their column."""
    fences = {}
    for name, (q1, q3) in quantiles(df, columns, [0.25, 0.75]).items():
        reach = factor * (q3 - q1) if q1 is not None else None
        fences[name] = (q1 - reach, q3 + reach) if reach is not None else (None, None)
    return _flag_outside(df, keys, fences)


def outliers_zscore(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *, limit: float = 3.0) -> DataFrame:
    """Values more than ``limit`` sample deviations from the mean of their column."""
    row = df.agg(
        *[F.avg(known(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(known(df, c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    fences = {}
    for i, c in enumerate(columns):
        mean, dev = row[f"m{i}"], row[f"s{i}"]
        fences[c] = (mean - limit * dev, mean + limit * dev) if dev else (None, None)
    return _flag_outside(df, keys, fences)


def cluster_balance(df: DataFrame, cluster: str, *, low: float = 0.05, high: float = 0.6) -> DataFrame:
    """Size and share of every cluster, and whether the share lies within bounds."""
    sizes = df.groupBy(column(cluster)).agg(F.count(F.lit(1)).alias("size"))
    # one row per cluster is left, so the window over all of them is small
    share = F.try_divide(F.col("size"), F.sum("size").over(Window.partitionBy()))
    verdict = (
        F.when(F.col("share") < low, "too small").when(F.col("share") > high, "too large").otherwise("ok")
    )
    return sizes.withColumn("share", share).withColumn("verdict", verdict)


def reconcile_totals(body: DataFrame, totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Column sums of the body beside the published totals; ``agrees`` is null where none is stated."""
    summed = _per_column(body, columns, {"body_sum": {c: F.sum(column(c)) for c in columns}})
    stated = _per_column(totals, columns, {"stated_total": {c: F.sum(column(c)) for c in columns}})
    return summed.join(stated, "column_name", "full").withColumn(
        "agrees", F.col("stated_total") == F.coalesce(F.col("body_sum"), F.lit(0))
    )
