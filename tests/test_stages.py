import json

import pytest
from district_counts import (
    COST_BY_K,
    DISTRICTS,
    MEASURES,
    SECOND_CLUSTER,
    SILHOUETTE_BY_K,
    SINGLE_CLUSTERS,
    TOP_TEN,
    ZERO_MEASURES,
)
from helpers import bag, rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyscape import jobs
from tallyscape.operators import cluster, quality, reports, reshape
from tallyscape.plans import stages
from tallyscape.sinks.files import write_csv
from tallyscape.sources.files import read_inferred_csv
from tallyscape.sources.tables import read_query

ENTITY = "kabupaten_kota"


@pytest.fixture(scope="module")
def raw(spark):
    ddl = f"{ENTITY} string, " + ", ".join(f"{m} int" for m in MEASURES)
    return spark.createDataFrame(DISTRICTS, ddl).withColumns({m: F.lit(0) for m in ZERO_MEASURES})


@pytest.fixture(scope="module")
def filled(raw):
    return stages.transform(stages.ingest(raw, ENTITY, reject=["Kota"]), ENTITY)


@pytest.fixture(scope="module")
def run(filled):
    return stages.cluster(filled, ENTITY, partitions=1)


def test_33_districts_and_their_top_ten(filled):
    assert filled.count() == 33
    totals = reshape.with_total(filled, MEASURES + ZERO_MEASURES)
    assert rows(reshape.top_by(totals, "total", ENTITY, 10).select(ENTITY, "total")) == TOP_TEN


def test_known_clusters(run):
    got = dict(rows(run.assigned.select(ENTITY, "cluster_id")))
    singles = {name: 2 + i for i, name in enumerate(SINGLE_CLUSTERS)}
    expected = {n: singles.get(n, 1 if n in SECOND_CLUSTER else 0) for n, *_ in DISTRICTS if n != "Kota"}
    assert got == expected
    assert run.silhouette == pytest.approx(SILHOUETTE_BY_K[4], abs=1e-4)
    assert run.cost == pytest.approx(COST_BY_K[4], abs=1e-2)


def test_sweep_finds_the_known_best_k(filled):
    placed = cluster.in_fixed_layout(filled, ENTITY, 1)
    best, tried = cluster.sweep(cluster.feature_vectors(placed, MEASURES + ZERO_MEASURES))
    assert best == 2
    for k, cost, silhouette, is_best in rows(tried):
        assert cost == pytest.approx(COST_BY_K[k], abs=1e-2)
        assert silhouette == pytest.approx(SILHOUETTE_BY_K[k], abs=1e-4)
        assert is_best == (k == best)


def test_auto_k(filled):
    run = stages.cluster(filled, ENTITY, k="auto", max_k=3, partitions=1)
    assert run.k == 2 and run.sweep.count() == 2


def test_result_does_not_depend_on_the_input_layout(spark):
    data = [(i, float(i % 17), float((i * 7) % 23), float((i * i) % 31)) for i in range(400)]
    df = spark.createDataFrame(data, "k long, a double, b double, c double")
    outcomes = []
    for layout in (df.repartition(1), df.repartition(7), df.repartition(4, "a")):
        run = stages.cluster(layout, "k", partitions=4)
        outcomes.append((bag(run.assigned.select("k", "cluster_id")), round(run.cost, 9)))
    assert outcomes[0] == outcomes[1] == outcomes[2]


def test_every_row_is_at_its_nearest_centre(spark):
    data = [(i, float(i % 17), float((i * 7) % 23)) for i in range(300)]
    df = spark.createDataFrame(data, "k long, a double, b double")
    vectors = cluster.feature_vectors(cluster.in_fixed_layout(df, "k", 3), ["a", "b"])
    model = cluster.fit(vectors, 5)
    centres = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster_id int, centre array<double>"
    )
    checked = cluster.nearest_centre(model.transform(vectors), vector_to_array("features"), centres)
    assert checked.filter("prediction <> cluster_id").count() == 0
    # the cost is that of the centres, which are the means once training has converged
    cost = checked.agg(F.sum("distance")).first()[0]
    assert cost == pytest.approx(cluster.training_cost(model), rel=1e-6)
    scaled = checked.withColumn("z", vector_to_array("features"))
    means = cluster.within_cluster_cost(scaled, "z", "prediction").agg(F.sum("cost")).first()[0]
    assert means == pytest.approx(cost, rel=1e-2) and means <= cost + 1e-9


def test_ids_are_canonical(run):
    sizes = rows(run.assigned.groupBy("cluster_id").count().orderBy("cluster_id"))
    assert sizes == [(0, 24), (1, 7), (2, 1), (3, 1)]


def test_long_route_drops_incomplete_rows(spark):
    long = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", None), ("b", "x", 2), (None, "x", 5), ("b", "y", 3)],
        "e string, c string, `Jumlah Kasus` int",
    )
    wide = stages.widen(reshape.rename(long, {"Jumlah Kasus": "m"}), "e", "c", "m")
    assert bag(wide) == [("a", 1, 0), ("b", 2, 3)]
    run = stages.cluster(wide, "e", k=2, scale=False, partitions=1)
    assert bag(run.assigned.select("e", "cluster_id")) == [("a", 0), ("b", 1)]


def test_transform_policies(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", 3, 4), ("c", 5, 6)], "e string, x int, y int")
    assert bag(stages.transform(df, "e")) == [("a", 1, 0), ("b", 3, 4), ("c", 5, 6)]
    assert bag(stages.transform(df, "e", missing="drop")) == [("b", 3, 4), ("c", 5, 6)]
    scaled = bag(stages.transform(df, "e", missing="drop", scale=True))
    assert scaled == [("b", 0.0, 0.0), ("c", 1.0, 1.0)]
    with pytest.raises(ValueError):
        stages.transform(df, "e", missing="guess")


def test_export_twice_gives_the_same_files(spark, run, tmp_path):
    def read(name):
        return bag(spark.read.option("header", True).option("inferSchema", True).csv(f"{tmp_path}/{name}"))

    names = ["cluster_sizes", "assignment", "clustered", "cluster_statistics", "burden", "bi_export"]
    stages.export(run, str(tmp_path), listed=["dbd", "diare"])
    first = {n: read(n) for n in names}
    stages.export(run, str(tmp_path), listed=["dbd", "diare"])
    assert {n: read(n) for n in names} == first
    assert first["cluster_sizes"] == [(0, 24), (1, 7), (2, 1), (3, 1)]
    assert len(first["clustered"]) == len(first["assignment"]) == len(first["bi_export"]) == 33
    summary = json.loads(spark.read.text(f"{tmp_path}/summary").first()[0])
    assert summary["k"] == 4 and summary["rows"] == 33 and summary["passes"] is True
    assert [s["members"] for s in summary["sizes"]] == [24, 7, 1, 1]


def test_star_and_its_reports(spark, run, tmp_path):
    labels = {"dbd": "DBD", "diare": "Diare"}
    star = stages.warehouse_tables(run, labels=labels, period=2020)
    assert {n: t.count() for n, t in star.items()} == {
        "entity": 33, "category": 12, "fact": 396, "assignment": 33, "wide": 33
    }
    assert all("created_at" in star[n].columns for n in ("fact", "assignment", "wide"))
    assert star["fact"].select("fact_id").distinct().count() == 396
    entities, categories, facts, assignment = (star[n] for n in ("entity", "category", "fact", "assignment"))
    top = reports.top_entities_in_latest_period(facts, entities, categories, "DBD")
    assert rows(top)[:2] == [("Deli Serdang", 803), ("M e d a n", 652)]
    totals = dict(rows(reports.category_totals_in_cluster(facts, entities, categories, assignment, 0)))
    assert "kusta" not in totals and totals["Diare"] > totals["DBD"] > 0
    report = reports.entity_cluster_report(assignment, entities, facts)
    write_csv(report, f"{tmp_path}/report")
    back = read_inferred_csv(spark, f"{tmp_path}/report")
    assert bag(back) == bag(report) and {r["facts"] for r in back.collect()} == {12}
    counts = read_query(
        spark,
        "SELECT cluster_id, count(DISTINCT entity) AS n FROM {a} WHERE cluster_id >= :low GROUP BY cluster_id",
        args={"low": 2},
        a=assignment,
    )
    assert bag(counts) == [(2, 1), (3, 1)]


def test_jobs_from_csv_to_outputs(spark, tmp_path):
    source = tmp_path / "wide.csv"
    lines = [",".join(["name", *MEASURES])] + [",".join(map(str, d)) for d in DISTRICTS]
    source.write_text("\n".join(lines))
    at = {n: str(tmp_path / n) for n in ("clean", "filled", "clustered", "out", "star")}
    jobs.main(["ingest", "--input", str(source), "--output", at["clean"], "--entity", "name", "--reject", "Kota"])
    jobs.main(["transform", "--input", at["clean"], "--output", at["filled"], "--entity", "name"])
    jobs.main(["cluster", "--input", at["filled"], "--output", at["clustered"], "--entity", "name", "--export", at["out"], "--warehouse", at["star"]])
    assert spark.read.parquet(f"{at['star']}/fact").count() == 33 * len(MEASURES)
    report = spark.read.option("header", True).csv(f"{at['out']}/entity_cluster_report")
    assert report.count() == 33 and {r["facts"] for r in report.collect()} == {str(len(MEASURES))}
    jobs.main(["report", "--input", at["star"], "--output", str(tmp_path / "reports"), "--category", "dbd"])
    top = spark.read.option("header", True).csv(str(tmp_path / "reports/top_entities_in_latest_period"))
    assert [r["entity"] for r in top.collect()][:2] == ["Deli Serdang", "M e d a n"]
    done = spark.read.parquet(at["clustered"])
    assert quality.row_count(done).first()["rows"] == 33
    assert {"features_raw", "features", "prediction", "cluster_id"} <= set(done.columns)


def test_ingest_stops_at_lines_that_do_not_fit(spark, tmp_path):
    source = tmp_path / "bad.csv"
    source.write_text("name,x\nA,1\nB,2 121\n")
    wanted = ["ingest", "--input", str(source), "--output", str(tmp_path / "o"), "--entity", "name", "--schema", "name string, x int"]
    with pytest.raises(SystemExit):
        jobs.main(wanted)
    jobs.main([*wanted, "--rejects", str(tmp_path / "bad")])
    assert bag(spark.read.parquet(str(tmp_path / "o"))) == [("A", 1)]
    assert [r["_line"] for r in spark.read.json(str(tmp_path / "bad")).collect()] == ["B,2 121"]


def test_database_load_in_order_without_a_database(run, monkeypatch):
    written = []
    monkeypatch.setattr(stages, "write_jdbc", lambda df, url, table, properties, mode: written.append((table, url, mode)))
    stages.load_database(stages.warehouse_tables(run), "jdbc:x:y", {"user": "u"}, prefix="p_")
    assert [w[0] for w in written][:2] == ["p_entity", "p_category"] and len(written) == 5
    assert set(written) == {(t, "jdbc:x:y", "overwrite") for t, _, _ in written}


def test_sweep_is_exported(filled, spark, tmp_path):
    found = stages.cluster(filled, ENTITY, k="auto", max_k=3, partitions=1)
    stages.export(found, str(tmp_path))
    assert [r["k"] for r in spark.read.option("header", True).csv(f"{tmp_path}/sweep").collect()] == ["2", "3"]


def test_a_repeated_key_is_refused(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "e string, x double")
    with pytest.raises(ValueError, match="not unique"):
        stages.cluster(df, "e", k=2)


def test_star_keys_stay_over_runs_and_rejects_are_kept(spark, tmp_path):
    def run(names):
        df = spark.createDataFrame([(n, float(i), float(i % 3)) for i, n in enumerate(names)], "e string, x double, y double")
        return stages.cluster(df, "e", k=2)

    registry = str(tmp_path / "keys")
    first = stages.warehouse_tables(run(["m", "n", "o", "p"]), registry=registry)
    ids = dict(rows(first["entity"].select("entity", "entity_id")))
    assert ids == {"m": 1, "n": 2, "o": 3, "p": 4}
    assert dict(rows(first["category"].select("category", "category_id"))) == {"x": 1, "y": 2}
    again = run(["a", "m", "o", "z" * 101])
    with pytest.raises(Exception, match="too long"):
        stages.warehouse_tables(again)["entity"].collect()
    star = stages.warehouse_tables(again, registry=registry, skip_rejects=True)
    assert dict(rows(star["entity"].select("entity", "entity_id"))) == {"a": 5, "m": 1, "o": 3}
    assert {r.entity_id for r in star["fact"].collect()} == {5, 1, 3}
    assert [r.entity for r in stages.warehouse_rejects(again).collect()] == ["z" * 101]


def test_a_name_twice_in_a_unique_column_is_refused(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 9.0)], "e string, x double")
    found = stages.cluster(df, "e", k=2)
    with pytest.raises(ValueError, match="category 'same'"):
        two = spark.createDataFrame([("a", 1.0, 2.0), ("b", 2.0, 1.0), ("c", 9.0, 5.0)], "e string, x double, y double")
        stages.warehouse_tables(stages.cluster(two, "e", k=2), labels={"x": "same", "y": "same"})
    assert stages.warehouse_tables(found)["entity"].count() == 3
