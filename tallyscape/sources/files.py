"""Parquet and CSV readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_declared_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    mode: str = "PERMISSIVE",
    rejects: str | None = None,
) -> DataFrame:
    """CSV with a declared schema bound by position, so no inference pass is needed.

    Cells that do not parse become null.  With ``rejects`` the raw text of each such
    line is kept in a column of that name; ``mode="FAILFAST"`` raises instead.
    """
    reader = spark.read.option("header", header).option("mode", mode)
    if rejects is not None:
        schema = T.StructType(schema.fields + [T.StructField(rejects, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", rejects)
    return reader.schema(schema).csv(path)


def read_inferred_csv(spark: SparkSession, path: str, *, sampling: float = 1.0) -> DataFrame:
    """CSV with names from the header and inferred types, at the cost of a second pass.

    A missing file raises.  ``sampling`` is the share of lines looked at for types.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", True)
        .option("samplingRatio", sampling)
        .csv(path)
    )


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer counts, least and greatest values from footers.

    It has its own settings, so those of ``spark`` stay; only a scan without filters, grouped by nothing or by
    partition columns, is answered that way, any other is read as usual.
    """
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.checkpoint.dir"):
        value = spark.conf.get(name, None)
        if value is not None and own.conf.isModifiable(name):
            own.conf.set(name, value)
    used = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in used if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own
