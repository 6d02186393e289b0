import json

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from spectrine import catalog, queries
from spectrine.errors import DataError, SessionClosed, UnsupportedCapability
from spectrine.functions import columns as C
from spectrine.functions.kernels import savgol_matrix
from spectrine.operators import audit, matrix, pls, split
from spectrine.plans.runner import Model, Session, evaluate, run, stable_hash
from spectrine.sources import datasets
from spectrine.streaming import write_scores


@pytest.fixture(scope="module")
def data(spark):
    df = datasets.synthetic(spark).cache()
    yield df
    df.unpersist()


def test_synthetic_checksums(data):
    rows = {r.sample_id: r for r in data.collect()}
    x = np.array([rows[i].spectrum for i in range(40)])
    y = np.array([rows[i].target for i in range(40)])
    assert x.shape == (40, 28)
    assert x.sum() == pytest.approx(2290.5068546375, abs=1e-8) and y.sum() == pytest.approx(27.9918241581, abs=1e-8)
    assert x[0, 1] == pytest.approx(2.0681558480, abs=1e-9) and y[39] == pytest.approx(1.4896232784, abs=1e-9)


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("snv_pls", {4: 0.1297578989}),
        ("savgol_pls", {4: 0.1328793738}),
        ("ks_snv_pls", {4: 0.1840665681}),
        ("methods", {2: 0.1776937284, 4: 0.1824919437, 6: 0.1762316358, 8: 0.1844077666, 10: 0.1783155572}),
    ],
)
def test_parity_fixtures(data, name, want):
    result = run(queries.DEFINITIONS[name], data)
    got = {r.n_components: r.rmse for r in result.variants.collect()}
    assert got == pytest.approx(want, abs=1e-6)
    assert result.selected["n_components"] == min(want, key=want.get)
    if "ks" in name or name == "methods":
        test = [r.sample_id for r in result.split.where("partition = 'test'").orderBy("ord").collect()]
        assert test == [2, 5, 7, 9, 16, 18, 19, 21, 24, 34, 36, 38]
    figures = evaluate(result.predictions, "rmse", "mae").collect()
    assert len(figures) == len(want)
    with pytest.raises(UnsupportedCapability):
        evaluate(result.predictions, "unknown")


def test_session_round_trip(spark, data, tmp_path):
    session = Session.start(queries.DEFINITIONS["snv_pls"], data)
    path = tmp_path / "s.json"
    session.save(path)
    with pytest.raises(FileExistsError):
        session.save(path)
    want = {r.sample_id: r.prediction for r in session.predict(data).collect()}
    with Session.load(path, spark) as again:
        got = {r.sample_id: r.prediction for r in again.predict(data).collect()}
        assert got == pytest.approx(want, abs=1e-12)
    for use in (again.export, lambda: again.predict(data)):
        with pytest.raises(SessionClosed):
            use()
    doc = json.loads(path.read_text())
    doc["definition"]["name"] = "other"
    (tmp_path / "t.json").write_text(json.dumps(doc))
    with pytest.raises(DataError):
        Session.load(tmp_path / "t.json")
    assert stable_hash({"b": 1, "a": 2}) == stable_hash({"a": 2, "b": 1})
    session.model.save(tmp_path / "m.json")
    assert Model.load(tmp_path / "m.json").width == 28
    with pytest.raises(Exception, match="values"):
        Model.load(tmp_path / "m.json").transform(spark.range(1).select(F.array(F.lit(1.0)).alias("spectrum"))).collect()


def test_stream_scores_like_a_table(spark, data, tmp_path):
    model = run(queries.DEFINITIONS["savgol_pls"], data).model
    data.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    write_scores(stream, model, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination(60)
    got = {r.sample_id: r.prediction for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == pytest.approx({r.sample_id: r.prediction for r in model.transform(data).collect()}, abs=1e-12)


def test_guards(spark, data):
    ragged = spark.createDataFrame([(0, [1.0], 1.0), (1, [1.0, 2.0], 2.0)], matrix.SCHEMA)
    with pytest.raises(DataError):
        matrix.require_rectangular(ragged)
    with pytest.raises(DataError):
        run(queries.DEFINITIONS["snv_pls"], data.limit(0))
    with pytest.raises(DataError):
        matrix.require_rows(ragged)
    with pytest.raises(DataError):
        matrix.from_rows(spark, [[1.0]], [])
    with pytest.raises(DataError):
        split.kennard_stone_split(data, 0.25, max_group=10)
    with pytest.raises(DataError):
        matrix.gather(data, spark.range(100).withColumnRenamed("id", "sample_id"))
    with pytest.raises(Exception, match="does not fit"):
        matrix.reshape_flat(spark.createDataFrame([([1.0, 2.0, 3.0],)], "flat array<double>"), 2).collect()


def test_split_of_a_large_group(spark):
    x = np.random.default_rng(0).normal(size=(20_001, 2))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "sample_id long, spectrum array<double>")
    rows = split.kennard_stone_split(df, 0.999).collect()
    assert sorted(r.sample_id for r in rows) == list(range(20_001))
    order = [r.sample_id for r in sorted((r for r in rows if r.partition == "train"), key=lambda r: r.ord)]
    near = ((x[:, None] - x[order[:2]]) ** 2).sum(-1).min(1)
    assert len(order) == 20
    for at in order[2:]:
        assert at == near.argmax()
        near = np.minimum(near, ((x - x[at]) ** 2).sum(1))


def test_snv_rows(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 6.0],), ([5.0, 5.0],), ([],)], "x array<double>")
    rows = [r.s for r in df.select(C.snv(F.col("x")).alias("s")).collect()]
    assert np.mean(rows[0]) == pytest.approx(0) and np.std(rows[0]) == pytest.approx(1)
    assert rows[1] == [0.0, 0.0] and rows[2] == []
    bad = spark.createDataFrame([([1.0, float("nan")], 1.0), ([1.0, None], 1.0), (None, 1.0), ([1.0], float("inf")), ([1.0], 2.0)], "spectrum array<double>, target double")
    assert matrix.finite_rows(bad).count() == 1


def test_positions_span_partitions(spark):
    df = spark.range(0, 1000, 7).withColumnRenamed("id", "sample_id").repartition(5)
    got = matrix.with_position(df, parts=4).orderBy("sample_id").collect()
    assert [r.position for r in got] == list(range(len(got)))


def test_positions_of_many_rows_written_out(spark, tmp_path):
    n = 300_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).alias("sample_id"), F.xxhash64("id").alias("x"), F.col("id").cast("string").alias("y"))
    matrix.with_position(df.repartition(9), parts=8).write.parquet(str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == n and back.where("position <> sample_id").isEmpty()
    places = [r.sample_id for r in matrix.even_sample(df, 60).orderBy("sample_id").collect()]
    assert places == C.even_places(n, 60)


def test_positions_with_nulls_and_ties(spark):
    rows = [(None, 1), (None, 2)] + [("a", i) for i in range(50)] + [(f"b{i:03d}", i) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(6)
    got = sorted((r.position, r.k or "") for r in matrix.with_position(df, order="k", parts=5).collect())
    assert [p for p, _ in got] == list(range(92)) and [k for _, k in got] == sorted(r[0] or "" for r in rows)
    assert matrix.with_position(df.limit(0), order="k").count() == 0


def test_filters_keep_odd_rows_apart(spark):
    wide = [float(v % 17) for v in range(9)]
    df = spark.createDataFrame([(1, wide), (2, None), (3, [1.0, None, 2.0] * 3), (4, wide)], "i int, x array<double>").coalesce(1)
    m, c = savgol_matrix(9, 5, 2)
    got = {r.i: r.s for r in df.select("i", C.linear(C.snv(F.col("x")), m, c).alias("s")).collect()}
    z = (np.array(wide) - np.mean(wide)) / np.std(wide)
    assert got[1] == pytest.approx(m @ z + c) and got[4] == got[1] and got[2] is None and got[3] is None
    with pytest.raises(Exception, match="8 values; the filter takes 9"):
        df.where("i = 1").select(C.linear(F.slice("x", 1, 8), m, c)).collect()


def test_run_refuses_values_that_are_not_finite(spark, data):
    for bad in ("null", "double('nan')", "double('inf')"):
        with pytest.raises(DataError, match="finite"):
            run(queries.DEFINITIONS["snv_pls"], data.withColumn("target", F.expr(f"if(sample_id = 3, {bad}, target)")))
    with pytest.raises(DataError):
        pls.fit(data.withColumn("target", F.expr("if(sample_id = 3, null, target)")), 2)


def test_large_means_do_not_cancel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3)) + 1e7
    y = (x - 1e7) @ [1.0, -2.0, 0.5] + 3e6
    df = matrix.from_rows(spark, x.tolist(), y.tolist()).repartition(4)
    np.testing.assert_allclose(pls.fit(df, 3)[2].coefficients, [1.0, -2.0, 0.5], atol=1e-6)


def test_sources_round_trip(spark, data, tmp_path):
    headers = list(range(1100, 1156, 2))
    named = matrix.with_position(data).withColumn("observation_id", F.format_string("s%03d", "sample_id"))
    datasets.write_csv_triple(named, headers, str(tmp_path / "csv"))
    back = datasets.read_csv_triple(spark, str(tmp_path / "csv"), headers)
    got = {r.observation_id: r for r in back.collect()}
    for r in named.collect():
        assert got[r.observation_id].spectrum == pytest.approx(r.spectrum) and got[r.observation_id].target == pytest.approx(r.target)
    rows = data.orderBy("sample_id").collect()
    for name, x in (("nested", [r.spectrum for r in rows]), ("flat", [v for r in rows for v in r.spectrum])):
        path = tmp_path / f"{name}.json"
        datasets.write_evidence(path, {"X": x, "y": [r.target for r in rows], "rows": 40, "cols": 28})
        again = datasets.read_json_dataset(spark, str(path)).orderBy("sample_id").collect()
        assert [r.spectrum for r in again] == [r.spectrum for r in rows]
    with pytest.raises(ValueError):
        datasets.write_evidence(tmp_path / "nan.json", {"v": float("nan")})
    predictions = run(queries.DEFINITIONS["snv_pls"], data).predictions
    datasets.write_predictions(predictions, str(tmp_path / "p"), scenario="a")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 40
    with pytest.raises(DataError):
        datasets.read_predictions(spark, str(tmp_path / "p"))


def test_audit_errors(spark):
    df = spark.createDataFrame([(1, [1, 2], [3])], "id int, a array<int>, b array<int>")
    with pytest.raises(Exception, match="differ in length"):
        audit.explode_vectors(df, {"a": "x", "b": "y"}).collect()
    with pytest.raises(DataError):
        audit.unique_match(spark.range(3), F.col("id") > 0)
    with pytest.raises(DataError):
        audit.unique_match(spark.range(3), F.col("id") > 5)
    assert audit.compare_by_id(*[spark.range(0).select(F.col("id").alias("sample_id"), F.lit(1.0).alias("target"), F.lit(1.0).alias("prediction"))] * 2).first().max_abs_target == 0.0


def test_chains_and_counts(spark):
    df = spark.createDataFrame([("a", "a", "a"), ("a", "b", "a"), (None, None, None), ("a", "a", None)], "x string, y string, z string")
    assert [(r.chain_equal, r.first_break) for r in audit.hash_chain(df, ["x", "y", "z"]).collect()] == [(True, None), (False, "y"), (False, "x"), (False, "z")]
    assert tuple(audit.case_threshold(df, "x").first()) == (1, False) and tuple(audit.case_threshold(df, "y").first()) == (2, True)
    assert tuple(audit.blocked_workers(spark.createDataFrame([("blocked",)] * 3 + [("x",), (None,)], "s string"), "s").first()) == (3, True)
    a = spark.range(5).select(F.col("id").alias("sample_id"), (-F.col("id")).alias("o"))
    assert tuple(audit.order_match(a, a, order_a="o", order_b="o").first()) == (5, 0, True)
    assert tuple(audit.order_match(a, a.where("sample_id > 0"), order_a="sample_id", order_b="o").first()) == (4, 3, False)  # id 2 is third in both


def test_catalog():
    assert catalog.require_module("arrays") is np
    with pytest.raises(UnsupportedCapability):
        catalog.require_module("nothing")
    assert catalog.export_gaps(["a", "b"], ["b", "c"]) == {"missing": ["a"], "extra": ["c"]}
    assert "split.kennard_stone" in catalog.manifest()["controllers"]


def test_entry_and_oracles(spark):
    assert __spark_entry__.entry(spark).count() == 3
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
