"""Reports over the star schema and the cluster assignment.

Facts are aggregated on their ids first and joined to names afterwards, so what meets a
dimension is one row per id: an id that owns a third of all facts is combined inside
the map tasks and never arrives as a hot join key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.functions.columns import column, row_total


def total_by(df: DataFrame, key: str, measure: str, *, total: str = "total") -> DataFrame:
    """Sum per key; rows without a key belong to no group."""
    return df.filter(column(key).isNotNull()).groupBy(column(key)).agg(F.sum(column(measure)).alias(total))


def average_by_category_and_period(
    facts: DataFrame,
    categories: DataFrame,
    *,
    category_id: str = "category_id",
    category: str = "category",
    period: str = "period",
    measure: str = "measure",
) -> DataFrame:
    """Average measure per category name and period, in that order."""
    partial = facts.groupBy(column(category_id), column(period)).agg(
        F.sum(column(measure)).alias("_sum"), F.count(column(measure)).alias("_n")
    )
    return (
        partial.join(categories.select(category_id, category), category_id)
        .groupBy(category, period)
        .agg(F.try_divide(F.sum("_sum"), F.sum("_n")).alias("average"))
        .orderBy(category, period)
    )


def top_entities_in_latest_period(
    facts: DataFrame,
    entities: DataFrame,
    categories: DataFrame,
    category_name: str,
    *,
    n: int = 5,
    entity_id: str = "entity_id",
    entity: str = "entity",
    category_id: str = "category_id",
    category: str = "category",
    period: str = "period",
    measure: str = "measure",
) -> DataFrame:
    """The ``n`` entities with most cases of one category in the last recorded period.

    The last period is a scalar subquery of the same plan.
    """
    latest = facts.agg(F.max(column(period))).scalar()
    wanted = categories.filter(column(category) == category_name).select(category_id)
    per_id = (
        facts.filter(column(period) == latest)
        .join(wanted, category_id, "left_semi")
        .groupBy(column(entity_id))
        .agg(F.sum(column(measure)).alias("_sum"))
    )
    return (
        per_id.join(entities.select(entity_id, entity), entity_id)
        .groupBy(entity)
        .agg(F.sum("_sum").alias("total"))
        .orderBy(F.col("total").desc(), entity)
        .limit(n)
    )


def category_totals_in_cluster(
    facts: DataFrame,
    entities: DataFrame,
    categories: DataFrame,
    assignment: DataFrame,
    cluster_id: int,
    *,
    entity_id: str = "entity_id",
    entity: str = "entity",
    category_id: str = "category_id",
    category: str = "category",
    cluster: str = "cluster_id",
    measure: str = "measure",
) -> DataFrame:
    """Total per category over the members of one cluster; categories without cases are left out."""
    members = assignment.filter(column(cluster) == cluster_id).select(entity)
    ids = entities.select(entity_id, entity).join(members, entity).select(entity_id)
    return (
        facts.select(entity_id, category_id, column(measure).alias("_sum"))
        .join(ids, entity_id, "left_semi")
        .groupBy(category_id)
        .agg(F.sum("_sum").alias("_sum"))
        .join(categories.select(category_id, category), category_id)
        .groupBy(category)
        .agg(F.sum("_sum").alias("total"))
        .filter(F.col("total") > 0)
        .orderBy(F.col("total").desc(), category)
    )


def entity_cluster_report(
    assignment: DataFrame,
    entities: DataFrame,
    facts: DataFrame,
    *,
    entity_id: str = "entity_id",
    entity: str = "entity",
    cluster: str = "cluster_id",
    fact_id: str = "fact_id",
    measure: str = "measure",
) -> DataFrame:
    """Per entity and cluster: number of facts and their sum.

    An entity without facts is kept, with count 0 and a null sum.  Sums are listed in
    falling order with nulls first.
    """
    per_id = facts.groupBy(column(entity_id)).agg(
        F.count(column(fact_id)).alias("_n"), F.sum(column(measure)).alias("_sum")
    )
    return (
        assignment.select(entity, cluster)
        .join(entities.select(entity_id, entity), entity)
        .join(per_id, entity_id, "left")
        .groupBy(entity, cluster)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("facts"), F.sum("_sum").alias("total"))
        .orderBy(cluster, F.col("total").desc_nulls_first(), entity)
    )


def cluster_sizes(assignment: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return assignment.groupBy(column(cluster)).agg(F.count(F.lit(1)).alias("members")).orderBy(column(cluster))


def entities_per_cluster(
    assignment: DataFrame,
    *,
    cluster: str = "cluster_id",
    entity: str = "entity",
    approximate: bool = False,
) -> DataFrame:
    """Distinct entities per cluster; exact unless ``approximate`` is asked for.

    The exact count first drops repeats per (cluster, entity), so a large cluster is
    spread over many tasks.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return (
        assignment.groupBy(column(cluster)).agg(distinct(column(entity)).alias("entities")).orderBy(column(cluster))
    )


def assignment_pairs(
    assignment: DataFrame, *, cluster: str = "cluster_id", entity: str = "entity", n: int | None = None
) -> DataFrame:
    """Rows per (cluster, entity) in order; anything above 1 is a repeat."""
    pairs = (
        assignment.groupBy(column(cluster), column(entity))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(column(cluster), column(entity))
    )
    return pairs if n is None else pairs.limit(n)


def assignment_by_name(
    entities: DataFrame,
    assignment: DataFrame,
    *,
    entity: str = "entity",
    cluster: str = "cluster_id",
    n: int | None = None,
) -> DataFrame:
    """Entities matched to the assignment by exact name, ordered by cluster and name."""
    joined = (
        entities.select(column(entity))
        .join(assignment.select(column(entity), column(cluster)), entity)
        .orderBy(column(cluster), column(entity))
    )
    return joined if n is None else joined.limit(n)


def with_cluster(wide: DataFrame, assignment: DataFrame, *, entity: str = "entity", cluster: str = "cluster_id") -> DataFrame:
    """Wide table with the cluster of each entity."""
    return wide.join(assignment.select(column(entity), column(cluster)), entity)


def cluster_statistics(clustered: DataFrame, columns: Sequence[str], *, cluster: str = "cluster_id") -> DataFrame:
    """One row per cluster: its size, and mean, min, max and sum of every measure."""
    stats = [
        fn(column(c)).alias(f"{c}_{label}")
        for c in columns
        for label, fn in (("mean", F.avg), ("min", F.min), ("max", F.max), ("sum", F.sum))
    ]
    return clustered.groupBy(column(cluster)).agg(F.count(F.lit(1)).alias("size"), *stats)


def burden_labels(
    clustered: DataFrame,
    columns: Sequence[str],
    *,
    cluster: str = "cluster_id",
    labels: tuple[str, str, str] = ("low", "medium", "high"),
) -> DataFrame:
    """Clusters ranked by mean total, 1 for the heaviest, with a label.

    First rank is ``high``, last ``low``, the others ``medium``.  The raw id says nothing
    about burden, so it plays no part.
    """
    means = clustered.groupBy(column(cluster)).agg(F.avg(row_total(clustered, list(columns))).alias("mean_total"))
    # one row per cluster is left
    ranked = means.withColumn("rank", F.dense_rank().over(Window.orderBy(F.col("mean_total").desc())))
    last = F.max("rank").over(Window.partitionBy())
    low, medium, high = labels
    return ranked.withColumn(
        "burden", F.when(F.col("rank") == 1, high).when(F.col("rank") == last, low).otherwise(medium)
    )


def bi_export(
    clustered: DataFrame, columns: Sequence[str], *, entity: str = "entity", cluster: str = "cluster_id"
) -> DataFrame:
    """One row per entity for dashboards: cluster, measures and their total."""
    return clustered.select(
        column(entity),
        column(cluster),
        *[column(c) for c in columns],
        row_total(clustered, list(columns)).alias("total"),
    )
