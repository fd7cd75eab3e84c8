"""Database writer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    keep_table: bool = True,
    batch: int = 10_000,
    connections: int = 16,
) -> dict[str, str]:
    """Writer options.  ``keep_table`` empties the table on overwrite instead of dropping
    it, so its keys, defaults and foreign keys stay."""
    return {
        **properties,
        "url": url,
        "dbtable": table,
        "truncate": str(keep_table).lower(),
        "batchsize": str(batch),
        "numPartitions": str(connections),
    }


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "errorifexists",
    **options: int | bool,
) -> None:
    """Save to a database table.  ``connections`` bounds how many tasks write at once."""
    df.write.format("jdbc").options(**jdbc_options(url, table, properties, **options)).mode(mode).save()
