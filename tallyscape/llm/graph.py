"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.session import materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: for every linked node the smallest node it reaches.

    Large-star and small-star rounds in turn, until no edge changes.  Every round is a few equi-joins and
    aggregates over the edges and is written to the shared folder, so nothing is gathered in one place
    and a lost executor costs one round.  Self-links and repeated links count once; no links, no rows.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    edges = materialise(pairs, "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "edges")
        before, now = now, state(edges)
        if now == before:
            break
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
