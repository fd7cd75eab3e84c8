"""Small things the text operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the contracts: a word is a run of anything but these bytes.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, UPPER, UPPER.lower())


def whole(text: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, case apart."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def on_workers(df: DataFrame) -> DataFrame:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or shipped with ``--py-files``; then this adds nothing.
    """
    environment = df.sparkSession.sparkContext.environment
    here = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, here])
    return df
