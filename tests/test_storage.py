"""Facts stored by period and bucket, and answers from file footers: results and plans."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import bag, rows
from tallyscape.operators import reports, stats, warehouse
from tallyscape.sinks.files import write_parquet
from tallyscape.sources.files import footer_session


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    facts = spark.range(3000).select(
        F.col("id").alias("fact_id"), (F.col("id") % 50).alias("entity_id"), (F.col("id") % 7).alias("category_id"),
        (2018 + F.col("id") % 4).cast("int").alias("period"), (F.col("id") % 11).alias("measure"),
    )
    entities = spark.range(50).select(F.col("id").alias("entity_id"), F.concat(F.lit("e"), "id").alias("entity"))
    categories = spark.range(7).select(F.col("id").alias("category_id"), F.concat(F.lit("c"), "id").alias("category"))
    path = str(tmp_path_factory.mktemp("star") / "facts")
    stored = warehouse.store_facts(facts, "facts_of_a_test", path, buckets=4)
    yield facts, entities, categories, stored, path
    spark.sql("DROP TABLE facts_of_a_test")


def test_stored_facts_are_the_facts(star):
    facts, _, _, stored, _ = star
    assert bag(stored.select(*facts.columns)) == bag(facts)


def test_an_entity_report_shuffles_no_facts(spark, star):
    facts, entities, _, stored, _ = star
    groups = entities.select("entity", (F.col("entity_id") % 3).alias("cluster_id"))
    report = reports.entity_cluster_report(groups, entities, stored)
    assert rows(report) == rows(reports.entity_cluster_report(groups, entities, facts))
    totals = stored.groupBy("entity_id").agg(F.sum("measure").alias("total"))
    assert "Exchange" not in plan(totals) and "Bucketed: true" in plan(totals)
    joined = stored.join(stored.groupBy("entity_id").agg(F.count("*").alias("n")).hint("merge"), "entity_id")
    assert "Exchange" not in plan(joined)


def test_one_period_reads_one_folder(spark, star):
    facts, entities, categories, stored, _ = star
    top = reports.top_entities_in_latest_period(stored, entities, categories, "c1")
    assert rows(top) == rows(reports.top_entities_in_latest_period(facts, entities, categories, "c1"))
    assert re.search(r"PartitionFilters: \[[^\]]*period#\d+ = (Reused)?(S|s)ubquery", plan(top)), plan(top)
    averages = reports.average_by_category_and_period(stored, categories)
    # what is shuffled are sums by category and period, not facts
    assert plan(averages).count("partial_sum(measure") == 1
    assert bag(averages) == bag(reports.average_by_category_and_period(facts, categories))
    recent = spark.createDataFrame([(2020, "now"), (2019, "then")], "period int, name string").filter("name = 'now'")
    pruned = stored.join(F.broadcast(recent), "period")
    assert "dynamicpruning" in plan(pruned) and pruned.count() == facts.filter("period = 2020").count()


def test_a_table_is_replaced(spark, star, tmp_path):
    facts, *_ = star
    for n in (10, 5):
        again = warehouse.store_facts(facts.limit(n), "facts_loaded_twice", str(tmp_path / "f"), buckets=2)
        assert again.count() == n
    spark.sql("DROP TABLE facts_loaded_twice")


def test_footers_answer_without_reading_rows(spark, tmp_path):
    df = spark.range(0, 1000, 1, 3).select(
        "id", F.when(F.col("id") % 4 > 0, (F.col("id") - 500).cast("int")).alias("gaps"), F.lit(None).cast("int").alias("none"),
        F.lit("x").alias("text"),
    )
    write_parquet(df, str(tmp_path / "t"))
    got = stats.footer_profile(spark, str(tmp_path / "t"), ["id", "gaps", "none"])
    assert rows(got) == [("id", 1000, 1000, 0, 999), ("gaps", 1000, 750, -499, 499), ("none", 1000, 0, None, None)]
    assert "PushedAggregation: [MIN(id), MAX(id)]" in plan(got)
    with pytest.raises(ValueError, match="not whole numbers: text"):
        stats.footer_profile(spark, str(tmp_path / "t"), ["text"])
    write_parquet(df.limit(0), str(tmp_path / "empty"))
    assert rows(stats.footer_profile(spark, str(tmp_path / "empty"), ["id"])) == [("id", 0, 0, None, None)]


def test_a_footer_session_leaves_the_settings_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    own = footer_session(spark)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before and own is not spark
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
