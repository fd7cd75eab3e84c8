from pathlib import Path

import pytest
from helpers import bag, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyscape.operators import quality
from tallyscape.session import checkpoint_dir, intermediate_tables, materialise
from tallyscape.sinks.files import write_csv, write_json, write_parquet
from tallyscape.sinks.jdbc import jdbc_options
from tallyscape.sources.files import read_declared_csv, read_inferred_csv, read_parquet
from tallyscape.sources.publication import merge_header, read_publication_csv
from tallyscape.sources.tables import literal_table, read_jdbc, read_query

SHEET = """\ufeff"Cases by place, 2020",,,,
,,,,
Place ,Fever (Suspect)  ,Cough ,HIV ,,Other
,,,New Cases ,All Cases  ,
Region,,,,,
01   N o r t h,2 121,-,8,9,
02   Lower   East ,0,,1 000,-,
City,,,,,
71  Port,         3 ,4,0,,
Whole Province,2 124,4,1 008,9,
Source : health office,,,,,
"""


def test_declared_csv_binds_by_position(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("name,x,y\nA,1,2\nB,2 121,-\nC,,3\n")
    schema = T.StructType.fromDDL("place string, first int, second int")
    assert bag(read_declared_csv(spark, str(path), schema)) == [("A", 1, 2), ("B", None, None), ("C", None, 3)]
    rejected = read_declared_csv(spark, str(path), schema, rejects="bad").filter(F.col("bad").isNotNull())
    assert [r["bad"] for r in rejected.collect()] == ["B,2 121,-"]
    with pytest.raises(Exception):
        read_declared_csv(spark, str(path), schema, mode="FAILFAST").collect()


def test_inferred_csv(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("Kind,Jumlah Kasus\na,1\nb,2\n")
    df = read_inferred_csv(spark, str(path))
    assert df.dtypes == [("Kind", "string"), ("Jumlah Kasus", "int")]
    with pytest.raises(Exception):
        read_inferred_csv(spark, str(tmp_path / "absent.csv"))


def test_publication_sheet(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(SHEET, encoding="utf8")
    body, totals, rejects = read_publication_csv(spark, str(path), rename={"hiv_all_cases": "hiv_total"})
    assert rejects.count() == 0
    assert body.columns == ["entity", "fever_suspect", "cough", "hiv_new_cases", "hiv_total", "other"]
    assert bag(body) == [
        ("Lower East", 0, None, 1000, None, None),
        ("N o r t h", 2121, None, 8, 9, None),
        ("Port", 3, 4, 0, None, None),
    ]
    assert rows(totals) == [("Whole Province", 2124, 4, 1008, 9, None)]
    checked = {r[0]: r[3] for r in rows(quality.reconcile_totals(body, totals, body.columns[1:]))}
    assert checked == {"fever_suspect": True, "cough": True, "hiv_new_cases": True, "hiv_total": True, "other": None}


def test_publication_rows_that_fit_nowhere(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text(SHEET + "101 Far,1,2,3,4,5\n7 Near,n.a.,1,1,1,1\n8 Wide,1,2,3,4,5,6\n,1,2,3,4,5\n9 Short,1,2\n", encoding="utf8")
    body, totals, rejects = read_publication_csv(spark, str(path))
    assert body.count() == 4 and totals.count() == 1
    assert sorted(r["reason"] for r in rejects.collect()) == ["no label", "not a number", "too few cells", "too many cells"]
    with pytest.raises(ValueError, match="file ends"):
        read_publication_csv(spark, str(path), header_lines=(98, 99))


def test_merged_heads_reach_right_only_over_sub_columns():
    assert merge_header(["A", "HIV ", "", "", "B"], ["", "New", "All", "", ""]) == ["a", "hiv_new", "hiv_all", "", "b"]


def test_query_text_binds_values(spark):
    df = spark.createDataFrame([("it's", 1), ("b", 2)], "n string, v int")
    assert rows(read_query(spark, "SELECT v FROM {t} WHERE n = :name", args={"name": "it's"}, t=df)) == [(1,)]


def test_literal_table(spark):
    assert rows(literal_table(spark, ["b", "a"])) == [(1, "b"), (2, "a")]


def test_file_round_trips(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, 2020), ("b", None, 2021)], "n string, v int, y int")
    for _ in range(2):
        write_parquet(df, f"{tmp_path}/p", partition_by=["y"])
        write_csv(df, f"{tmp_path}/c", files=1)
        write_json(df, f"{tmp_path}/j")
    assert bag(read_parquet(spark, f"{tmp_path}/p")) == bag(df)
    assert bag(read_inferred_csv(spark, f"{tmp_path}/c")) == bag(df)
    assert bag(spark.read.json(f"{tmp_path}/j").select("n", "v", "y")) == bag(df)
    assert len(list((tmp_path / "c").glob("part-*"))) == 1
    with pytest.raises(Exception):
        write_parquet(df, f"{tmp_path}/p", mode="errorifexists")
    with pytest.raises(Exception):
        write_csv(df.select(F.raise_error(F.lit("no")).alias("x")), f"{tmp_path}/e")


def test_jdbc_settings_without_a_database(spark):
    options = jdbc_options("jdbc:x:y", "t", {"user": "u"}, connections=4)
    assert options == {"user": "u", "url": "jdbc:x:y", "dbtable": "t", "truncate": "true", "batchsize": "10000", "numPartitions": "4"}
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:x:y", "t", {}, partition_column="id")


def test_intermediate_tables_are_deleted(spark):
    with intermediate_tables(spark):
        stored = materialise(spark.range(3))
        path = Path(stored.inputFiles()[0].replace("file://", "").replace("file:", "")).parent
        assert path.exists() and stored.count() == 3
    assert not path.exists()


def test_a_cluster_must_name_its_folder(spark):
    class Context:
        master = "local-cluster[2,1,1024]"

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *a: None)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_materialise_reads_back_the_same(spark):
    df = spark.range(10).withColumn("v", F.array(F.col("id").cast("double")))
    stored = materialise(df)
    assert bag(stored) == bag(df) and stored.dtypes == df.dtypes
    assert stored.inputFiles()[0].replace("file://", "").startswith(checkpoint_dir(spark).replace("file:", ""))
