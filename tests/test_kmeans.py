"""KMeans from keyed starts: the same clusters in any layout, all k together."""

import numpy as np
import pytest
from district_counts import DISTRICTS, MEASURES, SECOND_CLUSTER, SILHOUETTE_BY_K, SINGLE_CLUSTERS, ZERO_MEASURES
from helpers import bag, rows
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from tallyscape.operators import kmeans
from tallyscape.plans import stages

ENTITY = "kabupaten_kota"


@pytest.fixture(scope="module")
def filled(spark):
    ddl = f"{ENTITY} string, " + ", ".join(f"{m} int" for m in MEASURES)
    raw = spark.createDataFrame(DISTRICTS, ddl).withColumns({m: F.lit(0) for m in ZERO_MEASURES})
    return stages.transform(stages.ingest(raw, ENTITY, reject=["Kota"]), ENTITY)


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_known_clusters_in_any_layout(filled, partitions):
    run = stages.cluster(filled.repartition(partitions), ENTITY)
    singles = {name: 2 + i for i, name in enumerate(SINGLE_CLUSTERS)}
    expected = {n: singles.get(n, 1 if n in SECOND_CLUSTER else 0) for n, *_ in DISTRICTS if n != "Kota"}
    assert dict(rows(run.assigned.select(ENTITY, "cluster_id"))) == expected
    assert run.silhouette == pytest.approx(SILHOUETTE_BY_K[4], abs=1e-4)


def test_best_k_is_found_in_one_sweep(filled):
    run = stages.cluster(filled, ENTITY, k="auto")
    tried = {r.k: r for r in run.sweep.collect()}
    assert run.k == 2 and sorted(tried) == list(range(2, 9)) and tried[2].best
    assert tried[2].silhouette == pytest.approx(SILHOUETTE_BY_K[2], abs=1e-4)
    assert sum(r.best for r in tried.values()) == 1


def crowd(spark, n=600):
    rng = np.random.default_rng(4)
    data = [(i, *(rng.normal(size=3) + 3 * rng.integers(0, 3, size=3)).tolist()) for i in range(n)]
    return spark.createDataFrame(data, "k long, a double, b double, c double")


def test_labels_do_not_follow_the_layout(spark):
    found = []
    for partitions in (1, 7, 64):
        run = stages.cluster(crowd(spark).repartition(partitions, "b"), "k", k=6)
        found.append((bag(run.assigned.select("k", "cluster_id")), round(run.cost, 8), round(run.silhouette, 8)))
    assert found[0] == found[1] == found[2]


def test_together_is_as_each_alone(spark):
    points = kmeans.points(crowd(spark, 200), "k", ["a", "b", "c"])
    settings = {"max_iter": 30, "tol": 1e-6}
    held, weights = kmeans.candidates(points, 5, seed=1)
    assert weights.sum() == 200
    starts = {k: kmeans.drawn_centres(held, weights, k, seed=1) for k in (2, 5)}
    both = kmeans.lloyd(points, starts, **settings)
    for k in (2, 5):
        alone, taken = kmeans.lloyd(points, {k: starts[k]}, **settings)[k]
        assert np.allclose(alone, both[k][0]) and taken == both[k][1]


def test_rounds_are_those_of_plain_kmeans_and_scores_those_of_the_evaluator(spark):
    points = kmeans.points(crowd(spark, 150), "k", ["a", "b", "c"], scale=False)
    x = np.array([r.features for r in points.collect()])
    start = x[:4]
    centres = start
    for _ in range(100):
        own = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        moved = np.array([x[own == c].mean(0) for c in range(4)])
        if np.allclose(moved, centres, atol=1e-12):
            break
        centres = moved
    trained = kmeans.lloyd(points, {4: start}, max_iter=100, tol=1e-9)
    assert np.allclose(trained[4][0], centres)
    found = kmeans.measured(points, trained)[4]
    assert found.cost == pytest.approx(((x - centres[own]) ** 2).sum())
    assert found.silhouette == pytest.approx(ClusteringEvaluator().evaluate(kmeans.assigned(points, centres)))


def test_partial_sums_by_shuffle_are_the_same(spark, monkeypatch):
    points = kmeans.points(crowd(spark, 100), "k", ["a", "b", "c"])
    direct = kmeans.train(points, [2, 3], seed=5, max_iter=10, tol=1e-6)
    monkeypatch.setattr(kmeans, "DIRECT", 0)
    shuffled = kmeans.train(points, [2, 3], seed=5, max_iter=10, tol=1e-6)
    for k in (2, 3):
        assert np.allclose(direct[k].centres, shuffled[k].centres)
        assert direct[k].silhouette == pytest.approx(shuffled[k].silhouette)


def test_few_rows_equal_rows_and_gaps(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)] + [(9, 4.0, 2.0)], "k int, a double, b double")
    run = stages.cluster(same, "k", k=2)
    assert bag(run.assigned.select("k", "cluster_id")) == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (9, 1)]
    assert run.cost == pytest.approx(0) and run.silhouette == pytest.approx(5 / 6)
    with pytest.raises(ValueError, match="two clusters"):
        stages.cluster(same.filter("k < 9"), "k", k=2)
    with pytest.raises(ValueError, match="not unique"):
        stages.cluster(same.withColumn("k", F.lit(1)), "k", k=2)
    with pytest.raises(Exception, match="a has missing values"):
        stages.cluster(same.withColumn("a", F.when(F.col("k") > 0, F.col("a"))), "k", k=2)
