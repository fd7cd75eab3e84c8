"""The batch stages as functions from DataFrame to DataFrame.

wide route: ``ingest`` -> ``transform`` -> ``cluster`` -> ``export``
long route: ``widen`` -> ``cluster(scale=False)``
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyscape.functions.columns import column, measure_columns
from tallyscape.operators import clean, cluster as kmeans, features, kmeans as keyed, quality, reports, reshape, warehouse
from tallyscape.session import materialise
from tallyscape.sinks.files import write_csv, write_json
from tallyscape.sinks.jdbc import write_jdbc


def ingest(
    raw: DataFrame, entity: str, *, reject: Sequence[str] = (), drop_zero_rows: bool = False, **naming: bool
) -> DataFrame:
    """Tidy names, then keep the rows that have a usable one."""
    zero = measure_columns(raw, entity) if drop_zero_rows else None
    return clean.valid_keys(
        clean.with_clean_names(raw, entity, **naming), entity, reject=reject, zero_rows_of=zero
    )


def transform(cleaned: DataFrame, entity: str, *, missing: str = "zero", scale: bool = False) -> DataFrame:
    """Settle missing values (``zero`` fills, ``drop`` removes the row); optional 0..1 scaling."""
    columns = measure_columns(cleaned, entity)
    if missing not in ("zero", "drop"):
        raise ValueError("missing is zero or drop")
    settled = (
        clean.fill_missing(cleaned, columns) if missing == "zero" else clean.drop_missing(cleaned, columns)
    )
    return features.minmax_scale(settled, columns) if scale else settled


def widen(
    long: DataFrame, entity: str, category: str, measure: str, *, values: Sequence[str] | None = None
) -> DataFrame:
    """The long route: drop incomplete rows, pivot with sums, gaps become 0."""
    complete = clean.drop_missing(long, [entity, category, measure])
    return reshape.to_wide(complete, entity, category, measure, values=values)


@dataclass
class Run:
    entity: str
    columns: list[str]
    k: int
    cost: float
    silhouette: float
    assigned: DataFrame
    sweep: DataFrame | None = None


def cluster(
    wide: DataFrame,
    entity: str,
    *,
    k: int | str = 4,
    max_k: int = 8,
    scale: bool = True,
    seed: int | None = None,
    max_iter: int = kmeans.MAX_ITER,
    tol: float = kmeans.TOL,
    partitions: int | None = None,
) -> Run:
    """KMeans over all measures.  ``k="auto"`` takes the k of the best silhouette.

    The clusters follow from the rows, ``seed`` and settings alone.  With ``partitions`` Spark's own trainer is used instead,
    on rows placed by key in that many partitions: its clusters depend on their number.
    ``wide`` is read several times: hand in a stored or materialised table.
    """
    columns = measure_columns(wide, entity)
    if seed is None:
        seed = kmeans.SEED if scale else kmeans.RAW_SEED
    if partitions is not None:
        return _cluster_in_layout(wide, entity, columns, k, max_k, scale, seed, max_iter, tol, partitions)
    points = keyed.points(wide, entity, columns, scale=scale)
    tried = None
    if k == "auto":
        k, tried, _ = keyed.sweep(points, max_k, seed=seed, max_iter=kmeans.SWEEP_MAX_ITER, tol=tol)
    trained = keyed.train(points, [int(k)], seed=seed, max_iter=max_iter, tol=tol)[int(k)]
    if trained.silhouette is None:
        raise ValueError("a silhouette needs two clusters")
    labels = keyed.assigned(points, trained.centres).withColumnRenamed("key", "_key")
    done = wide.join(labels, column(entity) == F.col("_key")).drop("_key")
    done = materialise(done, "clustered")
    return Run(entity, columns, int(k), trained.cost, trained.silhouette, kmeans.canonical_ids(done, entity), tried)


def _cluster_in_layout(
    wide: DataFrame,
    entity: str,
    columns: list[str],
    k: int | str,
    max_k: int,
    scale: bool,
    seed: int,
    max_iter: int,
    tol: float,
    partitions: int,
) -> Run:
    placed = kmeans.in_fixed_layout(wide, entity, partitions).persist()
    try:
        vectors = kmeans.feature_vectors(placed, columns, scale=scale)
        tried = None
        if k == "auto":
            k, tried = kmeans.sweep(vectors, max_k, seed=seed)
        model = kmeans.fit(vectors, int(k), seed=seed, max_iter=max_iter, tol=tol)
        done = materialise(model.transform(vectors), "clustered")
    finally:
        placed.unpersist()
    return Run(
        entity,
        columns,
        int(k),
        kmeans.training_cost(model),
        kmeans.silhouette_score(done),
        kmeans.canonical_ids(done, entity),
        tried,
    )


def run_summary(run: Run) -> DataFrame:
    """One row: k, cost, silhouette, verdict and the size of each cluster."""
    sizes = reports.cluster_sizes(run.assigned)
    return sizes.agg(
        F.lit(run.k).alias("k"),
        F.lit(run.cost).alias("cost"),
        F.lit(run.silhouette).alias("silhouette"),
        F.lit(run.silhouette >= kmeans.GOOD_SILHOUETTE).alias("passes"),
        F.sum("members").alias("rows"),
        F.sort_array(F.collect_list(F.struct("cluster_id", "members"))).alias("sizes"),
    )


def warehouse_tables(
    run: Run,
    *,
    labels: Mapping[str, str] | None = None,
    period: int | None = None,
    registry: str | None = None,
    skip_rejects: bool = False,
) -> dict[str, DataFrame]:
    """The five tables of the star, typed and with defaults, ready for any writer.

    ``labels`` are the display names of the measure columns.  Entities are numbered in
    name order and categories in column order, so a rerun gives the same keys.  With a ``registry`` folder entities
    and categories keep the keys of earlier loads, also when others have been added.

    A name that is missing, too long or not unique raises.  ``skip_rejects`` leaves missing and too long ones to
    ``warehouse_rejects``; with the star, all rows of the run are then accounted for.
    """
    done = run.assigned.select(F.col(run.entity).alias("entity"), "cluster_id", *run.columns)
    if skip_rejects:
        done = done.filter(~warehouse.unfit(_NAMES))
    warehouse.require_unique(done, _NAMES)
    spark = done.sparkSession
    named = [((labels or {}).get(c, c), c) for c in run.columns]
    categories = spark.createDataFrame([(i, *n) for i, n in enumerate(named, start=1)], "category_id long, category string, column_name string")
    warehouse.require_unique(categories, warehouse.entity_target("category_id", "category"))
    if registry is None:
        entities = warehouse.dimension(done, "entity", key="entity_id")
    else:
        entities = warehouse.dimension(done, "entity", key="entity_id", registry=f"{registry}/entity")
        kept = warehouse.dimension(categories, "category", key="category_id", registry=f"{registry}/category")
        categories = categories.drop("category_id").join(kept, "category").select("category_id", "category", "column_name")
    keyed = done.join(entities.withColumnRenamed("entity_id", "id"), "entity")
    return {
        "entity": warehouse.conform(entities, warehouse.entity_target()),
        "category": warehouse.conform(categories, warehouse.entity_target("category_id", "category")),
        "fact": warehouse.load_facts(done, entities, categories, run.columns, period=period),
        "assignment": warehouse.conform(keyed, warehouse.assignment_target()),
        "wide": warehouse.conform(keyed, warehouse.wide_target(run.columns)),
    }


#: What is asked of the entity names of a run before they have a key.
_NAMES = [t for t in warehouse.entity_target() if t.name == "entity"]


def warehouse_rejects(run: Run) -> DataFrame:
    """The rows of a run that the star has no place for: entity missing or too long."""
    done = run.assigned.select(F.col(run.entity).alias("entity"), "cluster_id", *run.columns)
    return warehouse.name_rejects(done, _NAMES)


def star_reports(star: Mapping[str, DataFrame], category: str, cluster_id: int = 0, n: int = 5) -> dict[str, DataFrame]:
    """The usual reports over a star with the tables entity, category, fact and assignment."""
    entities, categories, facts, assignment = (star[t] for t in ("entity", "category", "fact", "assignment"))
    return {
        "table_counts": quality.table_counts(dict(star)),
        "fact_key_violations": warehouse.key_violations(facts, entities, "entity_id"),
        "average_by_category_and_period": reports.average_by_category_and_period(facts, categories),
        "top_entities_in_latest_period": reports.top_entities_in_latest_period(facts, entities, categories, category, n=n),
        "category_totals_in_cluster": reports.category_totals_in_cluster(
            facts, entities, categories, assignment, cluster_id
        ),
        "cluster_sizes": reports.cluster_sizes(assignment),
        "entities_per_cluster": reports.entities_per_cluster(assignment),
        "assignment_pairs": reports.assignment_pairs(assignment),
        "assignment_by_name": reports.assignment_by_name(entities, assignment),
        "entity_cluster_report": reports.entity_cluster_report(assignment, entities, facts),
    }


def load_database(
    tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str], *, prefix: str = "", mode: str = "overwrite"
) -> None:
    """Write the tables of a star to a database, dimensions before facts."""
    first = [t for t in ("entity", "category") if t in tables]
    for name in [*first, *(t for t in tables if t not in first)]:
        write_jdbc(tables[name], url, prefix + name, properties, mode=mode)


def export(
    run: Run, folder: str, *, listed: Sequence[str] | None = None, star: Mapping[str, DataFrame] | None = None
) -> None:
    """Write every output of a run below ``folder``; a rerun overwrites them.

    ``listed`` are the measures of the short assignment listing, all by default.  With ``star`` the report of
    entities and clusters is written too, and after a sweep the costs and scores of every k.
    """
    if run.sweep is not None:
        write_csv(run.sweep.coalesce(1).sortWithinPartitions("k"), f"{folder}/sweep")  # a row for each k
    if star is not None:
        report = reports.entity_cluster_report(star["assignment"], star["entity"], star["fact"])
        write_csv(report, f"{folder}/entity_cluster_report")
    done = run.assigned.select(run.entity, "cluster_id", *run.columns)
    assignment = done.select(run.entity, "cluster_id")
    write_csv(reports.cluster_sizes(assignment), f"{folder}/cluster_sizes")
    write_csv(reshape.members_in_order(assignment, "cluster_id", run.entity), f"{folder}/assignment")
    short = list(listed) if listed is not None else run.columns
    write_csv(done.select(run.entity, "cluster_id", *short), f"{folder}/clustered")
    write_csv(reports.cluster_statistics(done, run.columns), f"{folder}/cluster_statistics")
    write_csv(reports.burden_labels(done, run.columns), f"{folder}/burden")
    write_csv(reports.bi_export(done, run.columns, entity=run.entity), f"{folder}/bi_export")
    write_json(run_summary(run), f"{folder}/summary")
