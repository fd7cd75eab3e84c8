"""Every query over the given tables.  Each reads its tables whole."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.functions.columns import with_default
from tallyscape.operators import (
    clean,
    cluster,
    features,
    kmeans,
    quality,
    reports,
    reshape,
    sketches,
    stats,
    warehouse,
)
from tallyscape.plans import stages
from tallyscape.plans.retail import TABLES, Retail
from tallyscape.session import checkpoint_dir, materialise
from tallyscape.sinks import files
from tallyscape.sources.tables import literal_table, read_query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(build: Callable[[Retail], DataFrame]) -> Callable[[Retail], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, folder: build(Retail(spark, folder))
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the last digits depend on the order of a sum."""
    return df.withColumns({n: F.round(n, digits) for n, t in df.dtypes if t == "double"})


# ---- scans, projections and filters --------------------------------------------------


@query
def scan_count(t: Retail) -> DataFrame:
    return quality.row_count(t.table("lineitem"))


@query
def table_counts(t: Retail) -> DataFrame:
    return quality.table_counts({n: t.table(n) for n in TABLES})


@query
def table_digests(t: Retail) -> DataFrame:
    orders = t.table("orders").withColumn("period", F.year("o_orderdate").cast("int"))
    return sketches.table_digest(orders, ["period"], ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query
def period_reload(t: Retail) -> DataFrame:
    """Counts by customer, type and year, stored by year; the last year is loaded again, doubled, the others stay."""
    stored = t.long.select("entity_id", "category", F.col("period").cast("int").alias("period"), "measure")
    path = f"{checkpoint_dir(t.spark).rstrip('/')}/{t.spark.sparkContext.applicationId}/periods-{uuid4().hex}"
    files.reload_partitions(stored, path, ["period"])
    table = t.spark.read.schema(stored.schema).parquet(path)
    last = table.agg(F.max("period")).first()[0]
    again = materialise(table.filter(F.col("period") == last).withColumn("measure", F.col("measure") * 2), "again")
    files.reload_partitions(again, path, ["period"])
    return sketches.table_digest(t.spark.read.schema(stored.schema).parquet(path), ["period"], ["entity_id", "category", "measure"])


@query
def distinct_by_sketch(t: Retail) -> DataFrame:
    """Customers of each type from sketches kept by type and year, beside the exact count."""
    kept = materialise(sketches.distinct_sketches(t.lines, ["category", "period"], "entity_id"), "sketches")
    exact = t.lines.groupBy("category").agg(F.count_distinct("entity_id").alias("customers"))
    both = exact.join(sketches.merged_distinct(kept, ["category"]), "category")
    within = F.abs(F.col("distinct_values") - F.col("customers")) <= 0.065 * F.col("customers")  # five standard errors
    return both.select("category", "customers", within.alias("within"))


@query
def existing_table_counts(t: Retail) -> DataFrame:
    """The given tables as views under a prefix of their own; they are gone when the counts are known."""
    prefix = f"tallyscape_{uuid4().hex}_"
    wanted = ["nation", "part", "customer", "orders"]
    for name in wanted:
        t.table(name).createOrReplaceTempView(prefix + name)
    try:
        found = quality.existing_table_counts(t.spark, [prefix + n for n in [*wanted, "no_such_table"]])
        return found.withColumn("table_name", F.regexp_replace("table_name", prefix, ""))
    finally:
        for name in wanted:
            t.spark.catalog.dropTempView(prefix + name)


@query
def project_rename(t: Retail) -> DataFrame:
    renamed = reshape.rename(t.table("orders"), {"o_totalprice": "order total"})
    return reshape.project(renamed, {"order_key": "o_orderkey", "customer": "o_custkey", "order_total": "order total"})


@query
def add_column(t: Retail) -> DataFrame:
    lines = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    price = (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("net")
    return rounded(reshape.with_columns(lines, {"net_quantity": price, "l_linenumber": F.col("l_linenumber") + 1}))


@query
def equality_filter(t: Retail) -> DataFrame:
    wanted = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return t.table("orders").filter(wanted).select("o_orderkey", "o_custkey", "o_totalprice")


@query
def in_filter(t: Retail) -> DataFrame:
    kept = clean.keep_values(t.table("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])
    buyers = t.table("customer").filter(F.col("c_mktsegment") == "BUILDING")
    return clean.keep_values(
        kept.select("o_orderkey", "o_orderpriority", F.col("o_custkey").alias("c_custkey")), "c_custkey", buyers
    )


@query
def first_n_values(t: Retail) -> DataFrame:
    parts = t.table("part").select("p_partkey", "p_type", "p_retailprice")
    return clean.keep_first_values(parts, "p_type", 3)


@query
def preview_rows(t: Retail) -> DataFrame:
    return clean.preview(t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 10)


# ---- names ----------------------------------------------------------------------------


def _untidy(t: Retail) -> DataFrame:
    """Part names padded with blanks and tabs; some empty, blank, missing or a section label."""
    name = F.concat(F.lit("  "), F.regexp_replace("p_name", " ", " \t   "), F.lit("\t "))
    untidy = (
        F.when(F.col("p_size") == 1, None)
        .when(F.col("p_size") == 2, "   ")
        .when(F.col("p_size") == 3, "")
        .when(F.col("p_size") == 4, " Section ")
        .otherwise(name)
    )
    return t.table("part").select("p_partkey", untidy.alias("name"))


@query
def clean_names(t: Retail) -> DataFrame:
    return clean.with_clean_names(_untidy(t), "name")


@query
def valid_keys(t: Retail) -> DataFrame:
    return stages.ingest(_untidy(t), "name", reject=["Section"])


@query
def missing_names(t: Retail) -> DataFrame:
    return quality.missing_names(clean.with_clean_names(_untidy(t), "name"), "name", reject=["Section"])


# ---- missing values and duplicates ------------------------------------------------------


def _gappy(t: Retail) -> DataFrame:
    """Order lines with gaps beside the full quantity: the given order tables have none.

    Large quantities and zero discounts are null, zero taxes NaN, and a flag is missing.
    """
    c = F.col
    return t.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        c("l_quantity").alias("quantity"),
        F.when(c("l_quantity") < 45, c("l_quantity")).alias("l_quantity"),
        F.when(c("l_discount") != 0, c("l_discount")).alias("l_discount"),
        F.when(c("l_tax") == 0, float("nan")).otherwise(c("l_tax")).alias("l_tax"),
        F.when(c("l_linenumber") > 2, c("l_returnflag")).alias("l_returnflag"),
    )


GAPPY = ["l_quantity", "l_discount", "l_tax"]


def _labelled(t: Retail) -> DataFrame:
    """All documents with their labels; only some have any, so the gaps are real."""
    labels = t.table("labels").withColumnRenamed("doc_id", "label_id")
    documents = t.table("documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(labels, F.col("doc_id") == F.col("label_id"), "left")


@query
def null_profile_labels(t: Retail) -> DataFrame:
    return quality.null_profile(_labelled(t), ["doc_id", "n_chars", "quality", "toxic"])


@query
def impute_labels(t: Retail) -> DataFrame:
    """Missing labels by the mean."""
    return rounded(clean.impute(_labelled(t).select("doc_id", "quality", "toxic"), "mean", ["quality", "toxic"]))


@query
def fill_labels(t: Retail) -> DataFrame:
    return clean.fill_missing(_labelled(t).select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query
def drop_unlabelled(t: Retail) -> DataFrame:
    return clean.drop_missing(_labelled(t).select("doc_id", "lang", "quality"))


@query
def null_profile(t: Retail) -> DataFrame:
    return quality.null_profile(_gappy(t), [*GAPPY, "l_returnflag"])


@query
def table_profile(t: Retail) -> DataFrame:
    return quality.profile(t.table("lineitem"))


@query
def drop_empty_columns(t: Retail) -> DataFrame:
    unfilled = {"all_null": F.lit(None).cast("double"), "all_nan": F.lit(float("nan"))}
    return clean.drop_empty_columns(_gappy(t).drop("l_tax").withColumns(unfilled))


@query
def fill_zero(t: Retail) -> DataFrame:
    return clean.fill_missing(_gappy(t), GAPPY)


@query
def drop_nulls(t: Retail) -> DataFrame:
    return clean.drop_missing(_gappy(t))


@query
def impute_mean(t: Retail) -> DataFrame:
    return rounded(clean.impute(_gappy(t), "mean", GAPPY))


@query
def impute_median(t: Retail) -> DataFrame:
    return rounded(clean.impute(_gappy(t), "median", GAPPY))


@query
def impute_mode(t: Retail) -> DataFrame:
    return clean.impute(_gappy(t), "mode", [*GAPPY, "l_returnflag"])


def _repeating(t: Retail) -> DataFrame:
    return t.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_discount")


@query
def duplicate_count(t: Retail) -> DataFrame:
    return quality.duplicate_count(_repeating(t))


@query
def drop_duplicates(t: Retail) -> DataFrame:
    return clean.drop_duplicate_rows(_repeating(t))


@query
def distinct_values(t: Retail) -> DataFrame:
    return clean.distinct_values(t.table("lineitem"), "l_partkey")


# ---- reshaping --------------------------------------------------------------------------


@query
def wide_pivot(t: Retail) -> DataFrame:
    return t.wide_plan()


@query
def long_unpivot(t: Retail) -> DataFrame:
    return reshape.to_long(t.wide_plan(), "entity_id", t.measures)


@query
def row_total(t: Retail) -> DataFrame:
    return reshape.with_total(t.wide_plan(), t.measures).select("entity_id", "total")


@query
def top10_total(t: Retail) -> DataFrame:
    totals = reshape.with_total(t.wide_plan(), t.measures).select("entity_id", "total")
    return reshape.top_by(totals, "total", "entity_id", 10)


@query
def long_route_pivot(t: Retail) -> DataFrame:
    """Long rows, complete ones kept (here all), summed into columns."""
    wide = stages.widen(t.long, "entity_id", "category", "measure", values=t.category_names)
    return reshape.rename(wide, dict(zip(t.category_names, t.measures)))


@query
def long_route_incomplete(t: Retail) -> DataFrame:
    """The same route where documents without label are incomplete: good documents per source and language."""
    return stages.widen(_labelled(t), "source", "lang", "quality", values=["de", "en", "es", "fr"])


@query
def reconcile_totals(t: Retail) -> DataFrame:
    """Column sums of the wide table beside totals taken from the order lines and parts alone."""
    parts = t.table("part").select("p_partkey", "p_type")
    lines = t.table("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    stated = reshape.to_wide(
        lines.select(F.lit("all").alias("place"), "p_type", F.col("l_quantity").cast("long").alias("quantity")),
        "place",
        "p_type",
        "quantity",
        values=t.category_names,
    )
    totals = reshape.rename(stated, dict(zip(t.category_names, t.measures)))
    return quality.reconcile_totals(t.wide_plan(), totals, t.measures)


# ---- star schema ------------------------------------------------------------------------


@query
def dimension_keys(t: Retail) -> DataFrame:
    return warehouse.dimension(t.table("customer").select("c_name"), "c_name", key="entity_id")


@query
def fact_load(t: Retail) -> DataFrame:
    facts = warehouse.load_facts(t.wide_plan(), t.entities, _column_names(t), t.measures, entity="entity_id")
    return facts.drop("created_at")


def _column_names(t: Retail) -> DataFrame:
    return t.categories.withColumn("column_name", F.regexp_replace(F.lower("category"), "[^0-9a-z]+", "_"))


@query
def fact_rejects(t: Retail) -> DataFrame:
    """Counts of customers that a dimension of the solvent ones, without PROMO, does not know."""
    solvent = t.table("customer").filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("entity_id"))
    categories = _column_names(t).filter(F.col("category") != "PROMO")
    return warehouse.fact_rejects(t.wide_plan(), solvent, categories, t.measures, entity="entity_id")


@query
def seed_ignore_existing(t: Retail) -> DataFrame:
    existing = t.categories
    listed = literal_table(t.spark, ["PROMO", "ZINC", "STANDARD", "BRASS", "ZINC"], name="category")
    once = warehouse.add_missing_names(existing, listed, name="category", key="category_id")
    return warehouse.add_missing_names(once, listed, name="category", key="category_id")


@query
def keys_kept(t: Retail) -> DataFrame:
    """The customers of 1995 are registered first, all customers later: the first keep their keys."""
    registry = f"{checkpoint_dir(t.spark).rstrip('/')}/registry-{uuid4().hex}"
    buyers = t.table("orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("period"))
    early = buyers.filter(F.col("period") <= 1995).select("c_custkey").distinct()
    customers = t.table("customer").select("c_custkey", "c_name")
    first = warehouse.dimension(customers.join(early, "c_custkey", "left_semi"), "c_name", key="entity_id", registry=registry)
    first = materialise(first, "first_keys")
    second = warehouse.dimension(customers, "c_name", key="entity_id", registry=registry)
    old = first.select("c_name", F.col("entity_id").alias("first_id"))
    return second.join(old, "c_name", "left").select("entity_id", "c_name", "first_id")


@query
def fk_violations(t: Retail) -> DataFrame:
    solvent = t.table("customer").filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("o_custkey"))
    orders = t.table("orders").select("o_orderkey", "o_custkey")
    return warehouse.key_violations(orders, solvent, "o_custkey")


@query
def fk_valid(t: Retail) -> DataFrame:
    solvent = t.table("customer").filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("o_custkey"))
    return warehouse.valid_facts(t.table("orders").select("o_orderkey", "o_custkey"), solvent, "o_custkey")


@query
def fk_null_kept(t: Retail) -> DataFrame:
    """Documents keep their place where the label's key is null; keys of toxic ones are unknown to the dimension."""
    harmless = t.table("labels").filter(F.col("toxic") == 0).select(F.col("doc_id").alias("label_id"))
    return warehouse.valid_facts(_labelled(t).select("doc_id", "label_id"), harmless, "label_id")


@query
def apply_defaults(t: Retail) -> DataFrame:
    """Documents as facts of their label; those without label take the default."""
    rows = _labelled(t).select(
        F.col("doc_id").alias("fact_id"),
        F.col("doc_id").alias("entity_id"),
        F.col("toxic").alias("category_id"),
        F.col("quality").alias("measure"),
    )
    return warehouse.conform(rows, warehouse.fact_target()).drop("created_at")


@query
def default_value(t: Retail) -> DataFrame:
    return _gappy(t).select("l_orderkey", "l_linenumber", with_default(F.col("l_returnflag"), "?").alias("flag"))


# ---- reports over the long table ------------------------------------------------------------
# Totals are the same over order lines as over the long table, and need one shuffle less.


@query
def sum_by_period(t: Retail) -> DataFrame:
    return reports.total_by(t.lines, "period", "quantity")


@query
def sum_by_category(t: Retail) -> DataFrame:
    return reshape.top_by(reports.total_by(t.lines, "category", "quantity"), "total", "category", 10)


@query
def sum_by_entity(t: Retail) -> DataFrame:
    return reshape.top_by(reports.total_by(t.lines, "entity_id", "quantity"), "total", "entity_id", 10)


@query
def avg_by_category_period(t: Retail) -> DataFrame:
    return rounded(reports.average_by_category_and_period(t.facts, t.categories))


@query
def top5_latest_period(t: Retail) -> DataFrame:
    return reports.top_entities_in_latest_period(t.facts, t.entities, t.categories, "PROMO")


@query
def stored_top5_latest_period(t: Retail) -> DataFrame:
    """The same report from facts stored by period and customer."""
    return reports.top_entities_in_latest_period(t.stored_star, t.entities, t.categories, "PROMO")


@query
def stored_entity_totals(t: Retail) -> DataFrame:
    """Number and sum of every customer's facts, from the buckets without a shuffle of the facts."""
    segments = t.table("customer").select(F.col("c_name").alias("entity"), F.col("c_mktsegment").alias("cluster_id"))
    return reports.entity_cluster_report(segments, t.entities, t.stored_star)


@query
def sql_top5_latest_period(t: Retail) -> DataFrame:
    """The same report as SQL text, with the category as a bound value."""
    return read_query(
        t.spark,
        """
        SELECT entity, sum(measure) AS total
        FROM {facts} JOIN {entities} USING (entity_id) JOIN {categories} USING (category_id)
        WHERE category = :category AND period = (SELECT max(period) FROM {facts})
        GROUP BY entity ORDER BY total DESC, entity LIMIT 5
        """,
        args={"category": "PROMO"},
        facts=t.facts,
        entities=t.entities,
        categories=t.categories,
    )


# ---- reports over the assignment --------------------------------------------------------------


@query
def cluster_sizes(t: Retail) -> DataFrame:
    return reports.cluster_sizes(t.assignment)


@query
def entities_per_cluster(t: Retail) -> DataFrame:
    twice = t.assignment.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return reports.entities_per_cluster(twice)


@query
def assignment_pairs(t: Retail) -> DataFrame:
    return reports.assignment_pairs(t.assignment, n=20)


@query
def members_sorted(t: Retail) -> DataFrame:
    return reshape.members_in_order(t.assignment, "cluster_id", "entity")


@query
def assignment_by_name(t: Retail) -> DataFrame:
    return reports.assignment_by_name(t.entities, t.assignment, n=10)


@query
def category_totals_in_cluster(t: Retail) -> DataFrame:
    t = t.with_stored_facts()
    return reports.category_totals_in_cluster(t.facts, t.entities, t.categories, t.assignment, 0)


@query
def entity_cluster_report(t: Retail) -> DataFrame:
    t = t.with_stored_facts()
    return reports.entity_cluster_report(t.assignment, t.entities, t.facts)


@query
def left_report_unmatched(t: Retail) -> DataFrame:
    """The same report over documents and their labels: a document without label has count 0 and no sum."""
    entity = F.concat(F.lit("document "), F.col("doc_id")).alias("entity")
    entities = t.table("documents").select(F.col("doc_id").alias("entity_id"), entity)
    assignment = t.table("documents").select(entity, F.col("lang").alias("cluster_id"))
    labels = t.table("labels").select(
        F.col("doc_id").alias("fact_id"), F.col("doc_id").alias("entity_id"), F.col("quality").alias("measure")
    )
    return reports.entity_cluster_report(assignment, entities, labels)


@query
def wide_by_cluster(t: Retail) -> DataFrame:
    return reports.with_cluster(t.named_wide, t.assignment).orderBy("cluster_id", "entity")


@query
def cluster_stats(t: Retail) -> DataFrame:
    return rounded(reports.cluster_statistics(t.clustered, t.measures))


@query
def burden_labels(t: Retail) -> DataFrame:
    return rounded(reports.burden_labels(t.clustered, t.measures))


@query
def bi_export(t: Retail) -> DataFrame:
    return reports.bi_export(t.clustered, t.measures)


@query
def cluster_balance(t: Retail) -> DataFrame:
    return rounded(quality.cluster_balance(t.assignment, "cluster_id", low=0.15, high=0.22))


# ---- statistics --------------------------------------------------------------------------------


@query
def min_max(t: Retail) -> DataFrame:
    return stats.min_max(t.wide_plan(), t.measures)


@query
def footer_profile(t: Retail) -> DataFrame:
    """Counts and bounds of the key columns of the order lines, from file footers."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return stats.footer_profile(t.spark, f"{t.folder}/lineitem.parquet", keys)


@query
def describe(t: Retail) -> DataFrame:
    return rounded(stats.describe(t.table("lineitem"), LINE_MEASURES))


@query
def correlation(t: Retail) -> DataFrame:
    """The last column has one value only, so its correlations are null."""
    lines = t.table("lineitem").select(*LINE_MEASURES, F.lit(1).alias("flat"))
    return rounded(stats.correlations(lines, [*LINE_MEASURES, "flat"]))


@query
def outliers_iqr(t: Retail) -> DataFrame:
    return rounded(quality.outliers_iqr(t.wide, ["entity_id"], t.measures))


@query
def outliers_zscore(t: Retail) -> DataFrame:
    found = quality.outliers_zscore(t.wide, ["entity_id"], t.measures, limit=2.5)
    return rounded(found)


@query
def numeric_violations(t: Retail) -> DataFrame:
    lines = _gappy(t).withColumn("l_quantity", F.col("l_quantity") - 10)
    return quality.numeric_violations(lines, GAPPY)


@query
def minmax_scaled(t: Retail) -> DataFrame:
    flat = t.wide.withColumn("flat", F.lit(7))
    return rounded(features.minmax_scale(flat, [*t.measures, "flat"]))


@query
def standardised(t: Retail) -> DataFrame:
    flat = t.wide.withColumn("flat", F.lit(7))
    return rounded(features.standardise(flat, [*t.measures, "flat"]))


# ---- clustering ----------------------------------------------------------------------------------


@query
def nearest_centre(t: Retail) -> DataFrame:
    return rounded(t.nearest.select("entity_id", "cluster_id", "distance"))


@query
def nearest_label_centre(t: Retail) -> DataFrame:
    """Vectors to the nearest of the label means."""
    vectors = t.table("embeddings")
    centres = cluster.moments(vectors, "embedding", "label").select("cluster_id", "centre")
    found = cluster.nearest_centre(vectors, F.col("embedding").cast("array<double>"), centres)
    return rounded(found.select("vec_id", "label", "cluster_id", "distance"))


@query
def within_cluster_cost(t: Retail) -> DataFrame:
    return rounded(cluster.within_cluster_cost(t.table("embeddings"), "embedding", "label"))


@query
def cost_to_centres(t: Retail) -> DataFrame:
    return rounded(t.nearest.agg(F.count(F.lit(1)).alias("rows"), F.sum("distance").alias("cost")), 4)


@query
def silhouette(t: Retail) -> DataFrame:
    scored = cluster.silhouettes(t.table("embeddings"), "embedding", "label")
    return rounded(scored.select("vec_id", "label", "silhouette"))


@query
def silhouette_by_cluster(t: Retail) -> DataFrame:
    scored = cluster.silhouettes(t.nearest, t.scaled_measures, "cluster_id")
    return rounded(scored.groupBy("cluster_id").agg(F.avg("silhouette").alias("silhouette")))


@query
def silhouette_gate(t: Retail) -> DataFrame:
    return rounded(cluster.silhouette_gate(cluster.silhouettes(t.nearest, t.scaled_measures, "cluster_id")))


@query
def kmeans_scaled(t: Retail) -> DataFrame:
    return stages.cluster(t.wide, "entity_id").assigned.select("entity_id", "cluster_id", *t.measures)


@query
def kmeans_raw(t: Retail) -> DataFrame:
    run = stages.cluster(t.wide, "entity_id", scale=False)
    return run.assigned.select("entity_id", "cluster_id", *t.measures)


def k_sweep_of(t: Retail) -> DataFrame:
    points = kmeans.points(t.wide, "entity_id", t.measures)
    return kmeans.sweep(points, 8, seed=cluster.SEED, max_iter=cluster.SWEEP_MAX_ITER, tol=cluster.TOL)[1]


@query
def k_sweep(t: Retail) -> DataFrame:
    return rounded(k_sweep_of(t))


@query
def kmeans_totals(t: Retail) -> DataFrame:
    """Sizes and column sums over all clusters add up to those of the wide table."""
    run = stages.cluster(t.wide, "entity_id")
    sums = [F.sum(c).alias(c) for c in t.measures]
    per_cluster = run.assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("rows"), *sums)
    return per_cluster.agg(F.sum("rows").alias("rows"), *sums)


@query
def kmeans_fixed_point(t: Retail) -> DataFrame:
    """Trained to the end, no row is nearer to another cluster's mean than to its own."""
    run = stages.cluster(t.wide, "entity_id", max_iter=500, tol=0.0)
    rows = run.assigned.select("entity_id", F.col("cluster_id").alias("own"), vector_to_array("features").alias("x"))
    rows = materialise(rows, "trained")
    means = cluster.moments(rows, "x", "own").select("cluster_id", "centre")
    nearest = cluster.nearest_centre(rows, F.col("x"), means).join(
        means.withColumnsRenamed({"cluster_id": "own", "centre": "own_centre"}), "own"
    )
    farther = cluster.squared_distance(F.col("x"), F.col("own_centre")) > F.col("distance") + 1e-9
    return nearest.agg(F.count(F.when(farther, 1)).alias("misplaced"))


@query
def sweep_shape(t: Retail) -> DataFrame:
    """Every k is tried, one is best, and it has the highest silhouette."""
    best = F.max(F.struct("silhouette", -F.col("k"))).over(Window.partitionBy())
    tried = k_sweep_of(t).withColumn("right", F.col("best") == (F.struct("silhouette", -F.col("k")) == best))
    return tried.agg(
        F.min("k").alias("least"), F.max("k").alias("most"), F.count_distinct("k").alias("tried"),
        F.count(F.when(F.col("best"), 1)).alias("best"), F.min("right").alias("right"),
    )


@query
def regional_profile(t: Retail) -> DataFrame:
    """All stages: facts, wide table, scaling, KMeans, statistics and burden of each cluster."""
    run = stages.cluster(stages.transform(t.wide, "entity_id"), "entity_id")
    done = run.assigned.select("entity_id", "cluster_id", *t.measures)
    statistics = reports.cluster_statistics(done, t.measures)
    burden = reports.burden_labels(done, t.measures).select("cluster_id", "mean_total", "rank", "burden")
    return rounded(statistics.join(burden, "cluster_id"))
