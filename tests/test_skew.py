"""One part, one order and one customer hold a third of all lines."""

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from tallyscape.plans.retail import Retail

# Thresholds low enough for a small test to count as skewed; no join side is small enough to broadcast.
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def skewed(spark, tmp_path):
    hot = F.col("id") % 3 == 0
    lines = spark.range(0, 300_000, 1, 8).select(
        F.when(hot, 1).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 900).alias("l_partkey"),
        (F.col("id") % 50).cast("double").alias("l_quantity"),
    )
    orders = spark.range(5000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") < 1700, 5).otherwise(F.col("id") % 400).alias("o_custkey"),
        F.timestamp_seconds(F.lit(900_000_000) + F.col("id") * 10_000).alias("o_orderdate"),
    )
    parts = spark.range(900).select(F.col("id").alias("p_partkey"), F.concat(F.lit("T"), F.col("id") % 4).alias("p_type"))
    for name, df in (("lineitem", lines), ("orders", orders), ("part", parts)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield Retail(spark, str(tmp_path)), lines, orders, parts
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_keys_are_split_and_nothing_is_lost(spark, skewed):
    t, lines, orders, parts = skewed
    got = t.long
    total = got.agg(F.sum("measure")).first()[0]
    assert total == lines.agg(F.sum("l_quantity").cast("long")).first()[0]
    got.collect()
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    wide = t.wide_plan()
    assert rows(wide.agg(F.count("*"), F.sum(sum((F.col(c) for c in t.measures), F.lit(0))))) == [
        (got.select("entity_id").distinct().count(), total)
    ]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert bag(Retail(spark, t.folder).long) == bag(got)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
