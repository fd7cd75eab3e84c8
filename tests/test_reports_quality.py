import math

import pytest
from helpers import bag, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyscape.operators import quality, reports


@pytest.fixture(scope="module")
def star(spark):
    entities = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r"), (4, "p2")], "entity_id long, entity string")
    categories = spark.createDataFrame([(1, "DBD"), (2, "Diare")], "category_id long, category string")
    facts = spark.createDataFrame(
        [(1, 1, 1, 5, 2020), (2, 1, 2, 7, 2021), (3, 2, 1, 5, 2021), (4, 4, 1, 5, 2021), (5, 2, 2, 0, 2021), (6, 1, 1, 1, 2021)],
        "fact_id long, entity_id long, category_id long, measure long, period int",
    )
    assignment = spark.createDataFrame([("p", 0), ("q", 0), ("r", 1), ("p2", 1)], "entity string, cluster_id int")
    return entities, categories, facts, assignment


def test_averages(star):
    entities, categories, facts, _ = star
    got = rows(reports.average_by_category_and_period(facts, categories))
    assert got == [("DBD", 2020, 5.0), ("DBD", 2021, 11 / 3), ("Diare", 2021, 3.5)]


def test_latest_period_top_list(spark, star):
    entities, categories, facts, _ = star
    got = reports.top_entities_in_latest_period(facts, entities, categories, "DBD", n=2)
    assert rows(got) == [("p2", 5), ("q", 5)]
    none = reports.top_entities_in_latest_period(facts.limit(0), entities, categories, "DBD")
    assert rows(none) == []


def test_category_totals_leave_out_zeros(star):
    entities, categories, facts, assignment = star
    got = reports.category_totals_in_cluster(facts, entities, categories, assignment, 0)
    assert rows(got) == [("DBD", 11), ("Diare", 7)]
    only_q = assignment.filter("entity = 'q'")
    assert rows(reports.category_totals_in_cluster(facts, entities, categories, only_q, 0)) == [("DBD", 5)]


def test_report_keeps_entities_without_facts(star):
    entities, _, facts, assignment = star
    got = rows(reports.entity_cluster_report(assignment, entities, facts))
    assert got == [("p", 0, 3, 13), ("q", 0, 2, 5), ("r", 1, 0, None), ("p2", 1, 1, 5)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.one_of(st.none(), st.integers(0, 9))), max_size=12))
def test_report_has_every_assigned_entity_and_every_fact(spark, star, pairs):
    entities, _, _, assignment = star
    facts = spark.createDataFrame([(i, e, m) for i, (e, m) in enumerate(pairs)], "fact_id long, entity_id long, measure long")
    got = reports.entity_cluster_report(assignment, entities, facts).collect()
    assert sorted(r["entity"] for r in got) == ["p", "p2", "q", "r"]
    assert sum(r["facts"] for r in got) == sum(1 for e, _ in pairs if e <= 4)


def test_repeats_in_the_assignment(spark):
    twice = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1)], "entity string, cluster_id int")
    assert rows(reports.cluster_sizes(twice)) == [(0, 2), (1, 1)]
    assert rows(reports.entities_per_cluster(twice)) == [(0, 1), (1, 1)]
    assert rows(reports.entities_per_cluster(twice, approximate=True)) == [(0, 1), (1, 1)]
    assert rows(reports.assignment_pairs(twice)) == [(0, "a", 2), (1, "b", 1)]
    assert rows(reports.assignment_pairs(twice, n=None)) == [(0, "a", 2), (1, "b", 1)]


def test_names_match_exactly(spark, star):
    entities = star[0]
    odd = spark.createDataFrame([("p ", 0), ("q", 0)], "entity string, cluster_id int")
    assert rows(reports.assignment_by_name(entities, odd)) == [("q", 0)]


def test_group_without_key_is_dropped(spark):
    df = spark.createDataFrame([("a", 1), (None, 5), ("a", 2)], "k string, m int")
    assert rows(reports.total_by(df, "k", "m")) == [("a", 3)]


def test_sum_beyond_int(spark):
    df = spark.createDataFrame([("a", 2**31 - 1)] * 3, "k string, m int")
    assert rows(reports.total_by(df, "k", "m")) == [("a", 3 * (2**31 - 1))]


def test_burden_goes_by_mean_total_not_by_id(spark):
    df = spark.createDataFrame([("a", 3, 1), ("b", 0, 9), ("c", 7, 5), ("d", 7, 5)], "entity string, cluster_id int, x int")
    got = {r["cluster_id"]: (r["rank"], r["burden"]) for r in reports.burden_labels(df, ["x"]).collect()}
    assert got == {0: (1, "high"), 7: (2, "medium"), 3: (3, "low")}


def test_statistics_and_export(spark):
    df = spark.createDataFrame([("a", 0, 1, 2), ("b", 0, 3, 4), ("c", 1, 5, 6)], "entity string, cluster_id int, x int, y int")
    stats = {r["cluster_id"]: r.asDict() for r in reports.cluster_statistics(df, ["x", "y"]).collect()}
    assert stats[0]["size"] == 2 and stats[0]["x_mean"] == 2.0 and stats[0]["y_sum"] == 6 and stats[1]["x_max"] == 5
    assert bag(reports.bi_export(df, ["x", "y"]))[1] == ("b", 0, 3, 4, 7)
    wide, assignment = df.drop("cluster_id"), df.select("entity", "cluster_id")
    assert bag(reports.with_cluster(wide, assignment))[0] == ("a", 1, 2, 0)


def test_profiles(spark):
    df = spark.createDataFrame([(1, None, math.nan), (2, "x", 1.0), (3, None, None)], "a int, b string, c double")
    assert rows(quality.null_profile(df, ["a", "b", "c"])) == [("a", 0), ("b", 2), ("c", 2)]
    got = rows(quality.profile(df))
    assert got == [("a", 0, "int", 3, 3), ("b", 1, "string", 3, 1), ("c", 2, "double", 3, 1)]
    assert rows(quality.row_count(df)) == [(3,)]


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(2, "a")] * 2 + [(3, "b")], "a int, b string")
    assert rows(quality.duplicate_count(df)) == [(3,)]
    assert rows(quality.duplicate_count(df.limit(0))) == [(0,)]


def test_missing_names(spark):
    df = spark.createDataFrame([("a",), (None,), (" ",), ("Total",)], "n string")
    assert rows(quality.missing_names(df, "n")) == [(2,)]
    assert rows(quality.missing_names(df, "n", reject=["Total"])) == [(3,)]


def test_numeric_violations(spark):
    df = spark.createDataFrame([(1, -1.0), (None, math.nan), (-3, 2.0)], "a int, b double")
    assert rows(quality.numeric_violations(df, ["a", "b"])) == [("a", 1, 1), ("b", 1, 1)]


def test_outliers(spark):
    df = spark.createDataFrame([(i, float(i % 5), 3) for i in range(40)] + [(99, 500.0, 3), (98, None, 3)], "k int, a double, flat int")
    assert [r[:3] for r in rows(quality.outliers_iqr(df, ["k"], ["a", "flat"]))] == [(99, "a", 500.0)]
    assert [r[:3] for r in rows(quality.outliers_zscore(df, ["k"], ["a", "flat"]))] == [(99, "a", 500.0)]
    empty = spark.createDataFrame([(1, None)], "k int, a double")
    assert rows(quality.outliers_iqr(empty, ["k"], ["a"])) == []


def test_balance(spark):
    df = spark.createDataFrame([(0,)] * 8 + [(1,)] * 2, "c int")
    got = {r["c"]: (r["size"], r["share"], r["verdict"]) for r in quality.cluster_balance(df, "c", low=0.25, high=0.7).collect()}
    assert got == {0: (8, 0.8, "too large"), 1: (2, 0.2, "too small")}


def test_table_counts(spark):
    assert rows(quality.table_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]
    spark.range(2).createOrReplaceTempView("present_table")
    assert rows(quality.existing_table_counts(spark, ["present_table", "absent_table"])) == [("present_table", 2)]
    assert rows(quality.existing_table_counts(spark, ["absent_table"])) == []


def test_reconcile(spark):
    body = spark.createDataFrame([(1, None, 2), (4, None, 5)], "a long, b long, c long")
    total = spark.createDataFrame([(5, None, 8)], "a long, b long, c long")
    got = {r[0]: r[1:] for r in rows(quality.reconcile_totals(body, total, ["a", "b", "c"]))}
    assert got == {"a": (5, 5, True), "b": (None, None, None), "c": (7, 8, False)}
