"""Every registered query against the checking SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tallyscape.plans.checks import CHECKS
from tallyscape.plans.queries import QUERIES
from tallyscape.plans.retail import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def table(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    want = duck.execute(CHECKS[name])
    columns = [c[0] for c in want.description]
    expected = table(columns, want.fetchall())
    assert table(df.columns, df.collect()) == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert expected[1] or name in ("outliers_iqr", "outliers_zscore")


ROWS_ONLY = {"kmeans_scaled": 150, "kmeans_raw": 150, "k_sweep": 7, "regional_profile": 4}


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql(spark, name):
    assert set(QUERIES) - set(CHECKS) == set(ROWS_ONLY)
    assert driver.queries()[name](spark, FOLDER).count() == ROWS_ONLY[name]


def test_entry(spark):
    df = driver.entry(spark)
    assert {"cluster_id", "size", "mean_total", "burden"} <= set(df.columns)
    assert sum(r["size"] for r in df.collect()) == 150
