"""Digests of tables, periods loaded again, and stored distinct counts."""

import random

import pytest
from pyspark.sql import functions as F

from tallyscape.operators import sketches
from tallyscape.sinks.files import reload_partitions

SCHEMA = "period int, name string, n long"


def rows(seed=0, periods=(2019, 2020, 2021, None)):
    rng = random.Random(seed)
    return [(p, rng.choice(["a", "b:1", "1:b", "", "é", None]), rng.choice([None, 0, -3, 2**60])) for p in periods for _ in range(40)]


def digests(df, by=("period",)):
    return {tuple(r[c] for c in by): (r.rows, r.digest) for r in sketches.table_digest(df, by).collect()}


def test_digest_ignores_order_and_layout(spark):
    data = rows()
    one = digests(spark.createDataFrame(data, SCHEMA).coalesce(1))
    random.Random(1).shuffle(data)
    assert digests(spark.createDataFrame(data, SCHEMA).repartition(7)) == one and len(one) == 4
    assert digests(spark.createDataFrame(data, SCHEMA).select("n", "name", "period")) == one


@pytest.mark.parametrize("change", ["value", "null", "copy", "less", "swap"])
def test_digest_sees_changes(spark, change):
    data = [(2019, "a", 1), (2019, "b", 2), (2020, "a", 1), (2020, None, None)]
    new = {
        "value": [(2019, "a", 3), *data[1:]],
        "null": [(2019, None, 1), *data[1:]],
        "copy": [data[0], *data],
        "less": data[1:],
        "swap": [(2019, "a", 2), (2019, "b", 1), *data[2:]],
    }[change]
    before, after = (sketches.table_digest(spark.createDataFrame(x, SCHEMA), ["period"]) for x in (data, new))
    assert [r.period for r in sketches.changed_groups(before, after, ["period"]).collect()] == [2019]
    assert sketches.changed_groups(before, before, ["period"]).count() == 0


def test_values_do_not_run_together(spark):
    pairs = [("a|1:b", "c"), ("a", "b|1:c"), ("", "a"), ("a", ""), (None, "a"), ("-", "a"), ("1:a", "b"), ("1", "a:b")]
    made = {sketches.table_digest(spark.createDataFrame([p], "x string, y string")).first().digest for p in pairs}
    assert len(made) == len(pairs)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert sketches.table_digest(none).first().rows == 0 and sketches.table_digest(none, ["period"]).count() == 0
    assert sketches.merged_distinct(sketches.distinct_sketches(none, ["period"], "name"), ["period"]).count() == 0
    with pytest.raises(ValueError, match="no column"):
        sketches.table_digest(none.select("period"), ["period"])


def test_a_period_is_loaded_again_without_the_others(spark, tmp_path):
    path, data = str(tmp_path / "facts"), rows()
    read = lambda: spark.read.schema(SCHEMA).parquet(path)
    reload_partitions(spark.createDataFrame(data, SCHEMA), path, ["period"])
    first = digests(read())
    assert first == digests(spark.createDataFrame(data, SCHEMA))
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "facts").glob("period=*/*.parquet") if "2020" not in str(p)}
    new = spark.createDataFrame(rows(5, [2020])[:11], SCHEMA)
    for _ in range(2):  # a second run changes nothing
        reload_partitions(new, path, ["period"])
        after = digests(read())
        assert after[(2020,)] == digests(new)[(2020,)] and after[(2020,)][0] == 11
        assert {k: v for k, v in after.items() if k != (2020,)} == {k: v for k, v in first.items() if k != (2020,)}
    assert all(p.stat().st_mtime_ns == t for p, t in files.items()) and files
    reload_partitions(new.limit(0), path, ["period"])
    assert digests(read()) == after


def test_stored_sketches_merge(spark):
    facts = spark.range(60_000).select(
        (F.col("id") % 3).alias("kind"), (F.col("id") % 11).alias("period"), F.pmod(F.xxhash64("id"), F.lit(9000)).alias("who")
    )
    facts = facts.unionByName(spark.createDataFrame([(7, 1, None)], "kind long, period long, who long"))
    kept = sketches.distinct_sketches(facts, ["kind", "period"], "who")
    assert kept.count() == 34
    exact = {r.kind: r.n for r in facts.groupBy("kind").agg(F.count_distinct("who").alias("n")).collect()}
    got = {r.kind: r.distinct_values for r in sketches.merged_distinct(kept, ["kind"]).collect()}
    assert set(got) == set(exact) and got[7] == exact[7] == 0
    assert all(abs(got[k] - exact[k]) <= 0.05 * exact[k] for k in (0, 1, 2))
