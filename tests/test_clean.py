import math
import statistics

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from tallyscape.functions.columns import is_missing, measure_columns, row_total
from tallyscape.functions.text import clean_name, parse_count, snake_name
from tallyscape.operators import clean


def test_clean_name_keeps_what_trim_keeps(spark):
    df = spark.createDataFrame([("  a   b ",), ("\tleading",), ("A s a h",), (None,)], "n string")
    assert [r[0] for r in rows(df.select(clean_name(F.col("n"))))] == ["a b", " leading", "A s a h", None]
    assert [r[0] for r in rows(df.select(clean_name(F.col("n"), trim_again=True)))][1] == "leading"
    joined = rows(df.select(clean_name(F.col("n"), join_letters=True)))
    assert [r[0] for r in joined] == ["ab", " leading", "Asah", None]


def test_parse_count(spark):
    df = spark.createDataFrame([("2 121",), ("         2 945 ",), ("-",), ("",), (None,), ("0",)], "c string")
    assert [r[0] for r in rows(df.select(parse_count(F.col("c"))))] == [2121, 2945, None, None, None, 0]


def test_snake_name():
    assert snake_name("Malaria (Suspek)  ") == "malaria_suspek"


def test_valid_keys_rejects_null_blank_and_labels(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 3), ("   ", 4), ("Section", 5), ("b", 0)], "n string, v int")
    assert bag(clean.valid_keys(df, "n", reject=["Section"])) == [("a", 1), ("b", 0)]
    assert bag(clean.valid_keys(df, "n", reject=["Section"], zero_rows_of=["v"])) == [("a", 1)]


def test_missing_covers_null_and_nan(spark):
    df = spark.createDataFrame([(1, None, 1), (2, math.nan, None), (3, 0.5, 2)], "k int, d double, i int")
    assert rows(df.select(is_missing(df, "d"), is_missing(df, "i"))) == [(True, False), (True, True), (False, False)]
    assert bag(clean.fill_missing(df, ["d", "i"])) == [(1, 0.0, 1), (2, 0.0, 0), (3, 0.5, 2)]
    assert bag(clean.drop_missing(df)) == [(3, 0.5, 2)]
    assert measure_columns(df, "k") == ["d", "i"]


def test_impute(spark):
    values = [1.0, 1.0, 2.0, 2.0, 10.0, None, math.nan]
    df = spark.createDataFrame([(i, v, f) for i, (v, f) in enumerate(zip(values, "aabbc" + "cc"))], "k int, v double, f string")
    df = df.withColumn("f", F.when(F.col("k") < 5, F.col("f")))
    present = values[:5]
    for strategy, expected in (("mean", statistics.mean(present)), ("median", statistics.median(present)), ("mode", 1.0)):
        filled = dict(rows(clean.impute(df, strategy, ["v"]).select("k", "v")))
        assert filled[5] == filled[6] == expected
    modes = dict(rows(clean.impute(df, "mode", ["v", "f"]).select("k", "f")))
    assert modes[5] == "a"  # tie of a and b goes to the smaller value
    empty = spark.createDataFrame([(1, None)], "k int, v double")
    assert rows(clean.impute(empty, "mean", ["v"])) == [(1, None)]
    with pytest.raises(ValueError):
        clean.impute(df, "nearest", ["v"])


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, math.nan, None), (2, None, None, 3)], "k int, a string, b double, c int")
    assert clean.drop_empty_columns(df).columns == ["k", "c"]


def test_duplicates_and_distinct(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b"), (None, None), (None, None)], "k int, n string")
    assert len(rows(clean.drop_duplicate_rows(df))) == 3
    assert len(rows(clean.distinct_values(df, "n"))) == 3


def test_keep_values_and_first_values(spark):
    df = spark.createDataFrame([("c", 1), ("a", 2), ("b", 3), ("a", 4), (None, 5)], "`Jenis Kelompok` string, v int")
    assert {r[1] for r in rows(clean.keep_first_values(df, "Jenis Kelompok", 2))} == {2, 3, 4}
    few = spark.createDataFrame([("a",), ("a",)], "`Jenis Kelompok` string")
    assert {r[1] for r in rows(clean.keep_values(df, "Jenis Kelompok", few))} == {2, 4}
    assert {r[1] for r in rows(clean.keep_values(df, "Jenis Kelompok", ["c"]))} == {1}


def test_preview_needs_an_order(spark):
    df = spark.range(100)
    assert rows(clean.preview(df, [F.col("id").desc()], 2)) == [(99,), (98,)]
    with pytest.raises(ValueError):
        clean.preview(df, [], 2)


def test_row_total_is_long(spark):
    df = spark.createDataFrame([(2**31 - 1, 1), (1, None)], "a int, b int")
    assert rows(df.select(row_total(df, ["a", "b"]))) == [(2**31,), (None,)]
