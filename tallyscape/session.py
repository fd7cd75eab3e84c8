"""Session helpers: a local session for tests, and cutting lineage on a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "tallyscape", **conf: str) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; only a local session may invent one."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    created = tempfile.mkdtemp(prefix="tallyscape-")
    spark.conf.set(CHECKPOINT_DIR, created)
    return created


_OPEN: list[list[str]] = []


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``materialise`` writes inside the block.

    Results still to be read have to be written elsewhere before the block ends.
    """
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(hadoop).delete(where, True)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several passes.  Unlike a cached frame it survives the
    loss of executors, keeps column pruning, and gives later joins the true size of
    the table instead of an estimate.  Files live under the application's id so an
    operator can remove them when the application has ended.
    """
    spark = df.sparkSession
    path = "/".join(
        [
            checkpoint_dir(spark).rstrip("/"),
            spark.sparkContext.applicationId,
            f"{name}-{uuid.uuid4().hex}",
        ]
    )
    for paths in _OPEN:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_package(df: DataFrame) -> DataFrame:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or shipped with ``--py-files``; then this changes nothing that matters.
    """
    environment = df.sparkSession.sparkContext.environment
    here = str(Path(__file__).resolve().parents[1])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, here])
    return df
