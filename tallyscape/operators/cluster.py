"""KMeans with repeatable results, and cluster measures as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyscape.functions.columns import column
from tallyscape.operators.distances import BLOCK_BYTES, compared
from tallyscape.operators.features import assemble, scaled_features
from tallyscape.session import materialise

PARTITIONS = 16

# The training settings results are compared under.
SEED, MAX_ITER, TOL = 42, 50, 1e-4
RAW_SEED = 123
SWEEP_MAX_ITER = 20
GOOD_SILHOUETTE = 0.3


# ---- training -------------------------------------------------------------------


def in_fixed_layout(df: DataFrame, key: str, partitions: int = PARTITIONS) -> DataFrame:
    """Rows placed by key, and ordered, in a set number of partitions.

    KMeans picks its starting centres per partition, so the same table in another layout
    gives other clusters.  With this one the result depends on the table and on ``partitions``, a setting
    to be kept between runs that are compared.  A repeated key raises, as its rows would meet in one
    partition in no order.
    """
    twice = df.groupBy(column(key)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
    if twice is not None:
        raise ValueError(f"{key} is not unique: {twice[0]!r}")
    return df.repartition(partitions, column(key)).sortWithinPartitions(column(key))


def feature_vectors(df: DataFrame, columns: Sequence[str], *, scale: bool = True) -> DataFrame:
    """Vectors in a column ``features``, standardised unless ``scale`` is off."""
    return scaled_features(df, columns) if scale else assemble(df, columns)


def fit(
    features: DataFrame, k: int, *, seed: int = SEED, max_iter: int = MAX_ITER, tol: float = TOL
) -> KMeansModel:
    """KMeans on feature vectors; ``model.transform`` adds ``prediction`` to any such table."""
    return KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol).fit(features)


def training_cost(model: KMeansModel) -> float:
    """Squared distances of the training rows from their centres, summed."""
    return model.summary.trainingCost


def silhouette_score(assigned: DataFrame) -> float:
    """Mean silhouette of rows with ``features`` and ``prediction``."""
    return ClusteringEvaluator().evaluate(assigned)


def sweep(
    features: DataFrame,
    max_k: int = 8,
    *,
    seed: int = SEED,
    max_iter: int = SWEEP_MAX_ITER,
    parallelism: int = 4,
) -> tuple[int, DataFrame]:
    """Try every k from 2 on: the best k, and one row (k, cost, silhouette, best) for each.

    The highest silhouette wins, the smaller k on a tie.  The vectors are kept in memory
    or on disk between the fits, of which ``parallelism`` run side by side.
    """
    vectors = features.select("features").persist()

    def attempt(k: int) -> tuple[int, float, float]:
        model = fit(vectors, k, seed=seed, max_iter=max_iter)
        return k, float(training_cost(model)), float(silhouette_score(model.transform(vectors)))

    try:
        vectors.count()
        with ThreadPool(parallelism) as pool:
            tried = pool.map(inheritable_thread_target(features.sparkSession)(attempt), range(2, max_k + 1), 1)
    finally:
        vectors.unpersist()
    best = max(tried, key=lambda t: (t[2], -t[0]))[0]
    rows = [(k, cost, silhouette, k == best) for k, cost, silhouette in tried]
    schema = "k int, cost double, silhouette double, best boolean"
    return best, features.sparkSession.createDataFrame(rows, schema)


def canonical_ids(
    df: DataFrame,
    entity: str,
    *,
    cluster: str = "prediction",
    output: str = "cluster_id",
) -> DataFrame:
    """Cluster ids 0, 1, ... by size, largest first, then by smallest entity.

    Raw ids depend on the random start; these do not.  The new ids, one row per cluster, are joined on.
    """
    order = Window.orderBy(F.col("_size").desc(), F.col("_first"))
    mapping = (
        df.groupBy(column(cluster).alias("_old"))
        .agg(F.count(F.lit(1)).alias("_size"), F.min(column(entity)).alias("_first"))
        .select("_old", (F.row_number().over(order) - 1).alias("_new"))
    )
    kept = [column(c) for c in df.columns if c != output]
    return df.join(mapping, column(cluster) == F.col("_old"), "left").select(*kept, F.col("_new").alias(output))


# ---- distances to given centres ---------------------------------------------------


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x
    )


def nearest_centre(
    df: DataFrame,
    features: Column,
    centres: DataFrame,
    *,
    cluster: str = "cluster_id",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds the nearest centre's id and the squared distance to it; ties go to the lowest id.

    A row with a missing or infinite feature gets neither.  ``centres`` has columns ``cluster_id`` and ``centre``
    (array of double), any number of rows: they are read in blocks of ``block_bytes``, with a pass over the
    rows for each.  A centre with a missing or infinite number is nobody's nearest.
    """
    held = centres.select(
        "cluster_id", "centre", F.lit(0.0).alias("extra"), F.lit(1).cast("long").alias("size")
    )
    found, added = compared(df, features, held, block_bytes=block_bytes)
    return found.withColumns({cluster: F.col("_best_id"), "distance": F.col("_best")}).drop(*added)


def moments(df: DataFrame, features: str | Sequence[str], cluster: str) -> DataFrame:
    """Per cluster: row count, centre, and mean squared distance of its rows from the centre.

    ``features`` is one array column or a list of numeric columns.  Partial results are
    combined before the shuffle, so a cluster holding most rows is no bottleneck.
    """
    if isinstance(features, str):
        summary = Summarizer.metrics("count", "mean", "variance").summary(
            array_to_vector(column(features).cast("array<double>"))
        )
        spread = F.aggregate(vector_to_array(F.col("s.variance")), F.lit(0.0), lambda a, x: a + x)
        return (
            df.groupBy(column(cluster).alias("cluster_id"))
            .agg(summary.alias("s"))
            .select(
                "cluster_id",
                F.col("s.count").alias("size"),
                vector_to_array(F.col("s.mean")).alias("centre"),
                # the summary has the sample variance
                (spread * (F.col("s.count") - 1) / F.col("s.count")).alias("spread"),
            )
        )
    values = [column(c).cast("double") for c in features]
    spreads = [F.var_pop(v) for v in values]
    return df.groupBy(column(cluster).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("size"),
        F.array(*[F.avg(v) for v in values]).alias("centre"),
        sum(spreads[1:], spreads[0]).alias("spread"),
    )


def within_cluster_cost(df: DataFrame, features: str | Sequence[str], cluster: str) -> DataFrame:
    """Per cluster, the squared distances of its rows from their own mean, summed."""
    return moments(df, features, cluster).select(
        "cluster_id", "size", (F.col("size") * F.col("spread")).alias("cost")
    )


def silhouettes(
    df: DataFrame,
    features: str | Sequence[str],
    cluster: str,
    *,
    output: str = "silhouette",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Adds each row's silhouette under squared Euclidean distance.

    The mean squared distance of a row to a cluster is its squared distance to the
    centre plus the cluster's spread, so no pairs of rows are formed: every row is
    compared with one value per cluster, read in blocks as in ``nearest_centre``.  A cluster of one row scores 0.
    A row without cluster, or with a missing feature, has none.  A single cluster has no silhouette: it raises.
    """
    x = column(features).cast("array<double>") if isinstance(features, str) else F.array(
        *[column(c).cast("double") for c in features]
    )
    table = materialise(moments(df, features, cluster), "moments")
    single = F.raise_error(F.lit("a silhouette needs two clusters")).cast("double")
    few = table.limit(2).count() < 2
    held = table.select("cluster_id", "centre", F.col("spread").alias("extra"), "size")
    found, added = compared(df, x, held, own=column(cluster), block_bytes=block_bytes)
    size, b = F.col("_own_size"), F.col("_best")
    # the row itself is at distance 0 from the cluster it is averaged over
    a = F.try_divide(F.col("_own_value") * size, size - 1)
    score = F.when((size == 1) | (a == b), 0.0).otherwise((b - a) / F.greatest(a, b))
    score = F.when(size.isNotNull(), score)
    return found.withColumn(output, single if few else score).drop(*added)


def silhouette_gate(scores: DataFrame, *, threshold: float = GOOD_SILHOUETTE, silhouette: str = "silhouette") -> DataFrame:
    """One row: the mean silhouette and whether it passes."""
    return scores.agg(F.avg(column(silhouette)).alias("silhouette")).withColumn(
        "passes", F.col("silhouette") >= threshold
    )
