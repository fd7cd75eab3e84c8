"""Tables from a database, from SQL text and from literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; with a partition column it is read by many tasks at once.

    ``bounds`` only set the stride of the slices, rows outside them are read too.
    """
    given = [partition_column, bounds, partitions]
    if any(v is not None for v in given) and not all(v is not None for v in given):
        raise ValueError("partition_column, bounds and partitions go together")
    reader = spark.read.format("jdbc").options(**properties).option("url", url).option("dbtable", table)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_query(
    spark: SparkSession, sql: str, *, args: dict | None = None, **tables: DataFrame
) -> DataFrame:
    """Run SQL text over the given frames: ``{name}`` stands for a frame, ``:name`` for a value.

    Values are bound, never pasted into the text.
    """
    return spark.sql(sql, args=args, **tables)


def literal_table(
    spark: SparkSession, names: Iterable[str], *, key: str = "id", name: str = "name"
) -> DataFrame:
    """Two-column table of a literal list, numbered from 1 in list order."""
    schema = T.StructType(
        [T.StructField(key, T.LongType(), False), T.StructField(name, T.StringType(), False)]
    )
    return spark.createDataFrame(list(enumerate(names, start=1)), schema)
