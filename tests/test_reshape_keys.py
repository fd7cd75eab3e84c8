import pytest
from helpers import bag, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyscape.operators import keys, reshape, stats, warehouse

LONG = [("b", "x", 1), ("b", "y", 2), ("a", "x", 3), ("a", "x", 4), ("c", "z", 5)]


def test_pivot_sums_and_fills(spark):
    df = spark.createDataFrame(LONG, "e string, `Kind` string, `Cases` int")
    wide = reshape.to_wide(df, "e", "Kind", "Cases")
    assert wide.columns == ["e", "x", "y", "z"]
    assert bag(wide) == [("a", 7, 0, 0), ("b", 1, 2, 0), ("c", 0, 0, 5)]
    gaps = reshape.to_wide(df, "e", "Kind", "Cases", values=["z", "x"], fill=None, other="more")
    assert bag(gaps) == [("a", None, 7, None), ("b", None, 1, 2), ("c", 5, None, None)]


def test_pivot_sum_beyond_int(spark):
    df = spark.createDataFrame([("a", "x", 2**31 - 1)] * 2, "e string, c string, m int")
    assert rows(reshape.to_wide(df, "e", "c", "m")) == [("a", 2**32 - 2)]


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.integers(0, 50), st.tuples(*[st.integers(-5, 5)] * 3), min_size=1, max_size=12))
def test_pivot_undoes_unpivot(spark, table):
    wide = spark.createDataFrame([(k, *v) for k, v in table.items()], "k int, x long, y long, z long")
    back = reshape.to_wide(reshape.to_long(wide, "k", ["x", "y", "z"]), "k", "category", "measure")
    assert bag(back) == bag(wide)


def test_too_many_categories_raise(spark):
    spark.conf.set("spark.sql.pivotMaxValues", 5)
    try:
        with pytest.raises(ValueError):
            reshape.category_values(spark.range(10).select(F.col("id").cast("string").alias("c")), "c")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_top_by_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("c", 5), ("a", 5), ("b", 9), ("d", 5)], "k string, v int")
    assert rows(reshape.top_by(df, "v", "k", 3)) == [("b", 9), ("a", 5), ("c", 5)]


def test_members_in_order(spark):
    df = spark.createDataFrame([("b", 9), ("a", 9), ("z", 2)], "e string, c int")
    assert rows(reshape.members_in_order(df, "c", "e")) == [(2, "z"), (9, "a"), (9, "b")]


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_dense_keys_follow_the_order(spark, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    names = [f"n{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string").repartition(7)
    assert bag(keys.dense_keys(df, ["name"])) == sorted([(i, n) for i, n in enumerate(names, 1)], key=repr)
    assert rows(keys.dense_keys(df.limit(0), ["name"])) == []
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_fact_keys_have_no_bounds_and_repeats_raise(spark):
    wide = spark.createDataFrame([(f"e{i}", i, 2 * i, 202401) for i in range(50)], "entity string, a int, b int, year int")
    entities = warehouse.dimension(wide, "entity", key="entity_id")
    categories = spark.createDataFrame([(100_000, "A", "a"), (7, "B", "b")], "category_id long, category string, column_name string")
    facts = warehouse.load_facts(wide, entities, categories, ["a", "b"], period="year")
    assert sorted(r["fact_id"] for r in facts.collect()) == list(range(1, 101))
    assert {r["period"] for r in facts.collect()} == {202401}
    with pytest.raises(ValueError, match="more than one fact"):
        warehouse.load_facts(wide.union(wide), entities, categories, ["a", "b"], period="year")


def test_facts_and_rejects_equal_the_input(spark):
    wide = spark.createDataFrame([("p", 1, 2), ("q", 3, 4), (None, 5, 6)], "entity string, a int, b int")
    entities = spark.createDataFrame([(1, "p")], "entity_id long, entity string")
    categories = spark.createDataFrame([(1, "A", "a")], "category_id long, category string, column_name string")
    rejects = warehouse.fact_rejects(wide, entities, categories, ["a", "b"])
    assert bag(rejects.select("entity", "column_name", "missing")) == bag(
        spark.createDataFrame(
            [("p", "b", "category"), ("q", "a", "entity"), ("q", "b", "entity"), (None, "a", "entity"), (None, "b", "entity")],
            "e string, c string, m string",
        )
    )
    kept = warehouse.load_facts(wide, entities, categories, ["a", "b"], skip_rejects=True)
    assert kept.count() + rejects.count() == 6
    with pytest.raises(Exception, match="no id for"):
        warehouse.load_facts(wide, entities, categories, ["a", "b"])


def test_null_keys_are_valid_and_nothing_is_lost(spark):
    facts = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "f int, k long")
    known = spark.createDataFrame([(1,)], "k long")
    good, bad = warehouse.valid_facts(facts, known, "k"), warehouse.key_violations(facts, known, "k")
    assert bag(good.select("f")) == [(1,), (3,)] and bag(bad.select("f")) == [(2,)]


def test_name_rejects_and_repeated_values(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "x" * 101), (4, None)], "entity_id long, entity string")
    target = warehouse.entity_target()
    assert bag(warehouse.name_rejects(df, target).select("entity_id")) == [(3,), (4,)]
    assert bag(warehouse.repeated_values(df, target)) == [("entity", "a", 2)]
    assert warehouse.repeated_values(df, warehouse.fact_target()).count() == 0


def test_pivot_keeps_types_and_loses_no_row(spark):
    df = spark.createDataFrame([("a", "k.0", "0.10"), ("a", "k.0", "0.20"), ("b", "z", "1"), ("b", None, "2")], "e string, c string, m string")
    df = df.withColumn("m", F.col("m").cast("decimal(10,2)"))
    wide = reshape.to_wide(df, "e", "c", "m", values=["k.0"], other="rest")
    assert [str(v) for v in sorted(bag(wide))[0][1:]] == ["0.30", "0.00"] and str(sorted(bag(wide))[1][2]) == "3.00"
    with pytest.raises(Exception, match="category not listed"):
        reshape.to_wide(df, "e", "c", "m", values=["k.0"]).collect()
    big = spark.createDataFrame([(9007199254740993,)], "v long")
    assert rows(stats.min_max(big, ["v"])) == [("v", 9007199254740993, 9007199254740993)]


def test_conform_casts_defaults_and_checks(spark):
    target = warehouse.fact_target()
    df = spark.createDataFrame([(1, 2, None), (2, 3, 7)], "fact_id int, entity_id int, measure int")
    out = warehouse.conform(df, target)
    assert out.columns == [t.name for t in target]
    assert bag(out.drop("created_at")) == [(1, 2, None, 0, 2024), (2, 3, None, 7, 2024)]
    assert out.filter(F.col("created_at").isNull()).count() == 0
    with pytest.raises(Exception, match="must not be null"):
        warehouse.conform(df.withColumn("fact_id", F.lit(None)), target).collect()
    with pytest.raises(Exception, match="too long"):
        named = spark.createDataFrame([(1, "n" * 101)], "entity_id long, entity string")
        warehouse.conform(named, warehouse.entity_target()).collect()


def test_seeding_twice_adds_nothing(spark):
    first = warehouse.dimension(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "name string"), "name")
    seed = spark.createDataFrame([("c",), ("a",), ("c",)], "name string")
    once = warehouse.add_missing_names(first, seed)
    assert bag(once) == [(1, "a"), (2, "b"), (3, "c")]
    assert bag(warehouse.add_missing_names(once, seed)) == bag(once)
    none = first.limit(0)
    assert bag(warehouse.add_missing_names(none, seed)) == [(1, "a"), (2, "c")]


def test_load_facts_fills_the_star(spark):
    wide = spark.createDataFrame([("p", 1, None), ("q", 3, 4)], "entity string, dbd int, diare int")
    entities = warehouse.dimension(wide, "entity", key="entity_id")
    categories = spark.createDataFrame([(1, "DBD", "dbd"), (2, "Diare", "diare")], "category_id long, category string, column_name string")
    facts = warehouse.load_facts(wide, entities, categories, ["dbd", "diare"], period=2020)
    got = bag(facts.select("entity_id", "category_id", "measure", "period"))
    assert got == [(1, 1, 1, 2020), (1, 2, 0, 2020), (2, 1, 3, 2020), (2, 2, 4, 2020)]
    assert facts.select("fact_id").distinct().count() == 4
    assert rows(warehouse.key_violations(facts, entities, "entity_id")) == []
    only = entities.filter("entity = 'p'")
    assert warehouse.key_violations(facts, only, "entity_id").count() == 2
    assert warehouse.valid_facts(facts, only, "entity_id").count() == 2
    null_key = facts.withColumn("entity_id", F.lit(None).cast("long"))
    assert warehouse.key_violations(null_key, entities, "entity_id").count() == 0


def test_registered_names_keep_their_keys(spark, tmp_path):
    folder = str(tmp_path / "registry")
    load = lambda names: spark.createDataFrame([(n,) for n in names], "e string")
    get = lambda df, **k: dict(rows(warehouse.dimension(df, "e", key="i", registry=folder, **k).select("e", "i")))
    assert get(load(["b", "c", None, "c"])) == {"b": 1, "c": 2}
    assert get(load(["a", "b", "d"])) == {"a": 3, "b": 1, "d": 4}
    assert get(load(["a", "b", "d"])) == {"a": 3, "b": 1, "d": 4}
    assert get(load([])) == {}
    many = [f"n{i:04}" for i in range(500)]
    first = get(load(many).repartition(6))
    assert sorted(first.values()) == list(range(5, 505))
    everything = keys.registered_keys(load(["unknown"]), folder, name="e", key="i", register=False)
    assert everything.count() == 504 and everything.filter("e = 'unknown'").count() == 0
