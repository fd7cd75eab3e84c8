import numpy as np
import pytest
from helpers import bag, rows
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyscape.operators import cluster, features

POINTS = [(0, 0.0, 0.0), (0, 1.0, 0.0), (0, 0.0, 2.0), (1, 9.0, 9.0), (1, 8.0, 9.0), (2, -5.0, 4.0)]


@pytest.fixture(scope="module")
def points(spark):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(POINTS)], "id int, label int, x double, y double")
    return df.withColumn("v", F.array("x", "y").cast("array<float>"))


def brute_silhouette(label, xy):
    label, xy = np.array(label), np.array(xy)
    d = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(axis=2)
    scores = []
    for i, own in enumerate(label):
        same = (label == own) & (np.arange(len(label)) != i)
        if not same.any():
            scores.append(0.0)
            continue
        a = d[i][same].mean()
        b = min(d[i][label == other].mean() for other in set(label) - {own})
        scores.append((b - a) / max(a, b))
    return scores


@pytest.mark.parametrize("form", ["v", ["x", "y"]])
def test_silhouette_against_all_pairs(points, form):
    got = [r[0] for r in rows(cluster.silhouettes(points, form, "label").orderBy("id").select("silhouette"))]
    assert got == pytest.approx(brute_silhouette([p[0] for p in POINTS], [p[1:] for p in POINTS]))
    assert got[-1] == 0.0


def test_silhouette_equals_the_evaluator(points):
    vectors = features.assemble(points, ["x", "y"]).withColumn("prediction", F.col("label"))
    ours = cluster.silhouette_gate(cluster.silhouettes(points, ["x", "y"], "label")).first()
    assert ours["silhouette"] == pytest.approx(ClusteringEvaluator().evaluate(vectors))
    assert ours["passes"] is True


@pytest.mark.parametrize("form", ["v", ["x", "y"]])
def test_cost_is_the_distance_to_the_own_mean(points, form):
    got = {r[0]: r[2] for r in rows(cluster.within_cluster_cost(points, form, "label"))}
    for label in (0, 1, 2):
        xy = np.array([p[1:] for p in POINTS if p[0] == label])
        assert got[label] == pytest.approx(((xy - xy.mean(axis=0)) ** 2).sum())


def test_nearest_centre_and_its_ties(spark, points):
    centres = spark.createDataFrame([(7, [2.0, 0.0]), (3, [0.0, 0.0]), (5, [9.0, 9.0])], "cluster_id int, centre array<double>")
    got = cluster.nearest_centre(points, features.as_array(["x", "y"]), centres).orderBy("id")
    assert rows(got.select("cluster_id", "distance"))[:4] == [(3, 0.0), (3, 1.0), (3, 4.0), (5, 0.0)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 800, 8])
def test_blocks_of_centres_give_the_nearest_of_all(spark, block_bytes):
    rng = np.random.default_rng(7)
    many = 40 if block_bytes == 800 else 4 if block_bytes == 8 else 5000
    c = np.round(rng.normal(size=(many, 3)), 1) * rng.choice([1.0, 30.0], size=(many, 1))  # rounded: many ties
    x = np.round(rng.normal(size=(300, 3)), 1) * rng.choice([1.0, 30.0], size=(300, 1))
    centres = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "cluster_id int, centre array<double>")
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>")
    got = cluster.nearest_centre(data, F.col("v"), centres, block_bytes=block_bytes).orderBy("id").collect()
    d = np.cumsum((x[:, None, :] - c[None]) ** 2, axis=2)[:, :, -1]
    assert [r.cluster_id for r in got] == d.argmin(1).tolist() and [r.distance for r in got] == d.min(1).tolist()


def test_a_hundred_thousand_centres(spark):
    n = 100_000
    centres = spark.range(n).select(
        F.col("id").alias("cluster_id"), F.array(F.col("id") * 1.0, *[F.lit(0.0)] * 7).alias("centre")
    )
    data = spark.range(200).select("id", F.array(F.col("id") * 499.25, *[F.lit(0.0)] * 7).alias("v"))
    got = cluster.nearest_centre(data, F.col("v"), centres, block_bytes=4 << 20).collect()
    assert len(got) == 200
    for r in got:
        want = min(np.ceil(r.id * 499.25 - 0.5), n - 1)
        assert (r.cluster_id, r.distance) == (want, (r.id * 499.25 - want) ** 2)


def test_blocks_change_no_silhouette(spark):
    rng = np.random.default_rng(5)
    x, label = rng.normal(size=(120, 2)), rng.integers(0, 6, 120)
    data = spark.createDataFrame(
        [(i, f"c{g}", v.tolist()) for i, (g, v) in enumerate(zip(label.tolist(), x))], "id int, g string, v array<double>"
    )
    whole, cut = (
        [r[0] for r in cluster.silhouettes(data, "v", "g", block_bytes=b).orderBy("id").select("silhouette").collect()]
        for b in (1 << 20, 32)
    )
    assert whole == cut
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    for i in range(120):
        mean = {g: d[i, label == g].sum() / ((label == g).sum() - (g == label[i])) for g in range(6)}
        a, b = mean.pop(label[i]), min(mean.values())
        assert whole[i] == pytest.approx((b - a) / max(a, b))


def test_centres_and_rows_that_fit_nowhere(spark):
    inf = float("inf")
    centres = spark.createDataFrame(
        [(0, [None, 0.0]), (1, [inf, 0.0]), (None, [0.0, 0.0]), (3, [5.0, 0.0]), (4, [])], "cluster_id int, centre array<double>"
    )
    data = spark.createDataFrame([(0, [0.0, 0.0]), (1, [inf, 0.0]), (2, None), (3, [1.0]), (4, [1e200, 0.0])], "id int, v array<double>")
    got = rows(cluster.nearest_centre(data, F.col("v"), centres).orderBy("id").select("cluster_id"))
    assert [r[0] for r in got] == [3, None, None, None, 3]
    none = cluster.nearest_centre(data, F.col("v"), centres.filter("false"))
    assert {tuple(r) for r in none.select("cluster_id", "distance").collect()} == {(None, None)}


def test_a_missing_feature_has_no_nearest_centre(spark, points):
    centres = spark.createDataFrame([(0, [0.0, 0.0])], "cluster_id int, centre array<double>")
    gap = points.withColumn("y", F.when(F.col("id") > 0, F.col("y")))
    got = cluster.nearest_centre(gap, features.as_array(["x", "y"]), centres).orderBy("id")
    assert rows(got.select("cluster_id", "distance"))[0] == (None, None)


def test_one_cluster_has_no_silhouette(points):
    with pytest.raises(Exception, match="two clusters"):
        cluster.silhouettes(points.withColumn("label", F.lit(1)), "v", "label").collect()


def test_canonical_ids(spark):
    df = spark.createDataFrame([("d", 5), ("a", 9), ("b", 9), ("c", 2)], "e string, prediction int")
    got = dict(rows(cluster.canonical_ids(df, "e").select("e", "cluster_id")))
    assert got == {"a": 0, "b": 0, "c": 1, "d": 2}


def test_cost_never_rises_with_more_steps(spark):
    rng = np.random.default_rng(3)
    data = [(i, *map(float, rng.normal(size=3))) for i in range(300)]
    df = spark.createDataFrame(data, "k int, a double, b double, c double")
    vectors = cluster.feature_vectors(cluster.in_fixed_layout(df, "k"), ["a", "b", "c"])
    costs = [cluster.training_cost(cluster.fit(vectors, 4, max_iter=n, tol=0.0)) for n in (1, 2, 4, 8, 16)]
    assert all(later <= earlier + 1e-9 for earlier, later in zip(costs, costs[1:]))


def test_standardise_equals_the_ml_scaler(spark):
    df = spark.createDataFrame([(1, 2.0, 7), (2, 4.0, 7), (3, 9.0, 7)], "k int, a double, flat int")
    ours = rows(features.standardise(df, ["a", "flat"]).orderBy("k").select("a", "flat"))
    ml = features.scaled_features(df, ["a", "flat"]).orderBy("k").select(vector_to_array("features"))
    assert np.allclose(np.array(ours), np.array([r[0] for r in rows(ml)]))
    single = features.standardise(df.limit(1), ["a"], suffix="_z")
    assert rows(single.select("a_z")) == [(0.0,)] and "a" in single.columns


def test_standardise_keeps_missing_values_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "a double")
    got = [r[0] for r in rows(features.standardise(df, ["a"]))]
    assert got[1] is None and got[3] is None and got[0] == -got[2]


def test_minmax_equals_the_ml_scaler_but_for_flat_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 7), (2, 4.0, 7), (3, 9.0, 7)], "k int, a double, flat int")
    ours = bag(features.minmax_scale(df, ["a", "flat"]).select("a", "flat"))
    assembled = features.assemble(df, ["a"])
    scaler = MinMaxScaler(inputCol="features", outputCol="o").fit(assembled)
    ml = sorted(r[0][0] for r in rows(scaler.transform(assembled).select(vector_to_array("o"))))
    assert [a for a, _ in ours] == pytest.approx(ml) and {f for _, f in ours} == {0.0}


def test_assemble_refuses_missing_values(spark):
    with pytest.raises(Exception):
        features.assemble(spark.createDataFrame([(None,), (1.0,)], "a double"), ["a"]).collect()
