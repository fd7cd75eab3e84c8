"""Parquet, CSV and JSON writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def _writer(df: DataFrame, mode: str, files: int | None, partition_by: list[str] | None) -> DataFrameWriter:
    out = df if files is None else df.repartition(files)
    writer = out.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    files: int | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Parquet directory.  By default every task writes its own file.

    ``files`` asks for a fixed number, at the price of a shuffle that keeps the stages
    before it parallel.
    """
    _writer(df, mode, files, partition_by).parquet(path)


def reload_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace the partitions of a Parquet directory that ``df`` has rows of; all others stay as they are.

    Running it twice gives the same table, so a period can be loaded again after a failure without touching the
    rest.  Rows are placed by partition first, so a partition gets a few files and not one from every task; a
    partition much larger than others is split by adaptive execution.  A partition without new rows stays, and
    an empty ``df`` changes nothing.
    """
    placed = df.hint("rebalance", *partition_by)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    files: int | None = None,
    header: bool = True,
) -> None:
    """CSV directory with a header in each file; row order is kept only with one of ``orderBy``."""
    _writer(df, mode, files, None).option("header", header).csv(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """JSON lines, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
