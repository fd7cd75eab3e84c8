"""Surrogate keys without an un-partitioned window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from tallyscape.functions.columns import column
from tallyscape.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def dense_keys(df: DataFrame, order_by: Sequence[str], key: str = "id", *, start: int = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in the given order.

    The order should be unique, so that a rerun gives the same keys.  Rows are range
    partitioned and numbered inside each partition; the position is written with the
    row, and the per-partition counts, one small row per partition, give the offsets.
    """
    ordered = df.repartitionByRange(*[column(c) for c in order_by]).sortWithinPartitions(
        *[column(c) for c in order_by]
    )
    numbered = materialise(
        ordered.withColumn("_part", F.spark_partition_id()).withColumn(
            "_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        ),
        "keys",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_offset"))
    )
    return numbered.join(offsets, "_part").select(
        (F.col("_offset") + F.col("_row") + start).cast("long").alias(key), *[column(c) for c in df.columns]
    )


def registered_keys(
    names: DataFrame, folder: str, *, name: str = "name", key: str = "id", register: bool = True
) -> DataFrame:
    """key, name of every name the registry in ``folder`` knows, after the non-null new ones of ``names`` joined it.

    The registry is a Parquet table that only grows: a name keeps its key for good, whatever comes later.  New names of a
    load are numbered in their order after the last key; every partition takes a range as long as it has names.
    A load is one append, seen whole or not at all, so a failed one leaves nothing and can be run again;
    loads are to follow each other, as two at the same time would take the same keys.  With ``register`` off nothing is
    written and names that are not known are left out.
    """
    spark = names.sparkSession
    kind = names.schema[name].dataType
    schema = StructType([StructField(key, LongType()), StructField(name, kind)])
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    exists = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    known = spark.read.schema(schema).parquet(folder) if exists else spark.createDataFrame([], schema)
    if not register:
        return known
    wanted = names.select(column(name)).filter(column(name).isNotNull()).distinct()
    new = wanted.join(known.select(column(name)), name, "left_anti") if exists else wanted
    last = (known.agg(F.max(column(key))).first()[0] or 0) if exists else 0
    dense_keys(new, [name], key, start=last + 1).select(column(key), column(name)).write.mode("append").parquet(folder)
    return spark.read.schema(schema).parquet(folder)
