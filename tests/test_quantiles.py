import math
import random

import numpy as np
import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st

import tallyscape.operators.quantiles as module
from tallyscape.operators.quantiles import quantiles
from tallyscape.operators.stats import correlations, describe, min_max

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def check(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles(df, ["v"], PROBS, **options)["v"]
    present = [v for v in values if v is not None and not math.isnan(v)]
    assert got == pytest.approx(list(np.quantile(present, PROBS)), rel=1e-12, abs=1e-300)


def test_one_value_holds_a_third_of_the_rows(spark):
    rng = random.Random(1)
    values = [rng.gauss(0, 100) for _ in range(3000)] + [7.5] * 1500 + [None, math.nan]
    check(spark, values)
    check(spark, values, grid=8, accuracy=100, held=50)


def test_values_on_very_different_scales(spark):
    rng = random.Random(2)
    check(spark, [rng.choice([1e-300, 1e-9, 1.0, 1e9, 1e300, -1e308, 1e308]) * rng.random() for _ in range(500)], grid=16, accuracy=100, held=20)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=40))
def test_any_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles(df, ["v"], [0.0, 1.0], grid=4, accuracy=50, held=5)["v"]
    assert got == [min(values), max(values)]


def test_several_columns_in_one_go(spark):
    df = spark.createDataFrame([(i, float(i * i), None) for i in range(101)], "a int, b double, c double")
    assert quantiles(df, ["a", "b", "c"], [0.5, 0.25]) == {"a": [50.0, 25.0], "b": [2500.0, 625.0], "c": [None, None]}


def test_bad_requests(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,)], "v double")
    with pytest.raises(ValueError):
        quantiles(df, ["v"], [0.5])
    with pytest.raises(ValueError):
        quantiles(df, ["v"], [1.5])


def test_describe_and_min_max(spark):
    values = [1.0, 2.0, 4.0, 9.0, None, math.nan]
    df = spark.createDataFrame([(v, 3) for v in values], "a double, flat int")
    by_name = {r["column_name"]: r.asDict() for r in describe(df, ["a", "flat"]).collect()}
    a = by_name["a"]
    assert a["count"] == 4 and a["mean"] == 4.0 and (a["min"], a["max"]) == (1.0, 9.0)
    assert a["std"] == pytest.approx(np.std(values[:4], ddof=1))
    assert [a["q25"], a["q50"], a["q75"]] == list(np.quantile(values[:4], [0.25, 0.5, 0.75]))
    assert by_name["flat"]["std"] == 0.0
    assert rows(min_max(df, ["a", "flat"])) == [("a", 1.0, 9.0), ("flat", 3.0, 3.0)]
    assert min_max(df, ["flat"]).dtypes[1] == ("min", "int")


def test_correlation_of_a_flat_column_is_null(spark):
    data = [(1.0, 2.0, 5), (2.0, 4.5, 5), (3.0, 5.0, 5), (4.0, None, 5)]
    df = spark.createDataFrame(data, "a double, b double, c int")
    got = {(r[0], r[1]): r[2] for r in rows(correlations(df, ["a", "b", "c"]))}
    full = [(a, b) for a, b, _ in data if b is not None]
    assert got["a", "b"] == pytest.approx(np.corrcoef(*zip(*full))[0, 1])
    assert got["a", "c"] is None and got["b", "c"] is None


@pytest.mark.parametrize("kind", ["geometric", "lognormal", "constant", "two values"])
def test_few_passes_on_any_distribution(spark, kind, monkeypatch):
    rng = np.random.default_rng(4)
    values = {
        "geometric": [1.5**i for i in range(1000)],
        "lognormal": rng.lognormal(0, 5, 5000).tolist(),
        "constant": [3.0] * 3000 + rng.normal(size=50).tolist(),
        "two values": [1.0] * 2000 + [2.0] * 2000 + [1.5],
    }[kind]
    passes = []
    for name in ("_probe", "_count"):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, real=real: passes.append(1) or real(*a))
    check(spark, values, held=300)
    assert len(passes) <= 4


def test_stored_sketches_are_merged(spark):
    rng = np.random.default_rng(6)
    data = [(int(rng.integers(5)), float(v), None if v > 1 else float(v * v)) for v in rng.normal(size=3000)]
    df = spark.createDataFrame(data, "period int, a double, b double")
    stored = module.sketches(df, ["a", "b"], ["period"])
    assert stored.count() == 5
    got = quantiles(df, ["a", "b"], PROBS, stored=stored)
    assert got["a"] == pytest.approx(list(np.quantile([r[1] for r in data], PROBS)), rel=1e-12)
    assert got["b"] == pytest.approx(list(np.quantile([r[2] for r in data if r[2] is not None], PROBS)), rel=1e-12)


def test_a_misjudging_sketch_does_not_change_the_result(spark, monkeypatch):
    values = list(range(2000))
    real = module._probe

    def wrong(*given):
        return [module._Probed(p.bracket, p.under, p.rows, [x / 2 for x in p.found[:-1]] + p.found[-1:]) for p in real(*given)]

    monkeypatch.setattr(module, "_probe", wrong)
    check(spark, [float(v) for v in values])


def test_correlations_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(120, 30)) @ rng.normal(size=(30, 30)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"c {i}" for i in range(30)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], names).repartition(5)
    for block in (1024, 7):
        got = {(r[0], r[1]): r[2] for r in rows(correlations(df, names, block=block))}
        assert len(got) == 30 * 29 / 2
        for i in range(30):
            for j in range(i + 1, 30):
                both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
                assert got[names[i], names[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-8)
    assert correlations(df, names[:1]).count() == 0
    assert {r[2] for r in rows(correlations(df.limit(0), names[:3]))} <= {None}
