import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from spectrine import ml, queries
from spectrine.errors import DataError, UnsupportedCapability
from spectrine.functions import losses, metrics
from spectrine.functions.kernels import pls_from_moments
from spectrine.operators import pls
from spectrine.plans.runner import run
from spectrine.sources import datasets


@pytest.fixture(scope="module")
def data(spark):
    df = datasets.synthetic(spark).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", list(queries.DEFINITIONS))
def test_pipelines_equal_run_and_survive_a_round_trip(spark, data, name, tmp_path):
    result = run(queries.DEFINITIONS[name], data)
    k = result.selected["n_components"]
    pipeline = ml.pipeline_of(queries.DEFINITIONS[name], k)
    pipeline.write().save(str(tmp_path / "pipeline"))
    fitted = Pipeline.load(str(tmp_path / "pipeline")).fit(data)
    fitted.write().save(str(tmp_path / "model"))
    out = PipelineModel.load(str(tmp_path / "model")).transform(data)
    got = {r.sample_id: r.prediction for r in (out.where("partition = 'test'") if "partition" in out.columns else out).collect()}
    want = {r.sample_id: r.prediction for r in result.predictions.where(F.col("variant_idx") == result.selected["variant_idx"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)


def test_params_survive(data, tmp_path):
    stage = ml.SavitzkyGolay(inputCol="spectrum", outputCol="smooth", windowLength=7, polyorder=2, deriv=1, mode="mirror")
    stage.save(str(tmp_path / "s"))
    again = ml.SavitzkyGolay.load(str(tmp_path / "s"))
    assert {p.name: again.getOrDefault(p) for p in again.params} == {p.name: stage.getOrDefault(p) for p in stage.params}
    both = again.transform(data).select("smooth").first().smooth, stage.transform(data).select("smooth").first().smooth
    assert both[0] == both[1] and len(both[0]) == 28
    with pytest.raises(DataError):
        ml.PLSRegressionModel().transform(data)


def test_a_grid_is_one_pass_and_searches_work(spark, data, monkeypatch):
    passes = []
    real = pls.moments
    monkeypatch.setattr(pls, "moments", lambda *a, **k: passes.append(1) or real(*a, **k))
    stage = ml.PLSRegression()
    grid = ParamGridBuilder().addGrid(stage.nComponents, [1, 3, 5]).build()
    models = dict(stage.fitMultiple(data, grid))
    assert len(passes) == 1 and [models[i].fitted.n_components for i in range(3)] == [1, 3, 5]
    for i, k in enumerate((1, 3, 5)):
        assert np.allclose(models[i].fitted.coefficients, pls.fit(data, k)[k - 1].coefficients)
        assert models[i].getOrDefault(models[i].nComponents) == k
    search = CrossValidator(estimator=stage, estimatorParamMaps=grid, evaluator=ml.MetricEvaluator(metricName="rmse"), numFolds=2, seed=1)
    best = search.fit(data.repartition(1))
    assert len(best.avgMetrics) == 3 and min(best.avgMetrics) > 0
    assert best.bestModel.fitted.n_components == (1, 3, 5)[int(np.argmin(best.avgMetrics))]


def dense(x, y, k, w=None):
    w = np.ones(len(y)) if w is None else w
    m = pls_from_moments(w.sum(), w @ x, w @ y, (x * w[:, None]).T @ x, x.T @ (w * y), w @ (y * y), k)[k - 1]
    return m.coefficients, m.intercept


def table(spark, x, y):
    return spark.createDataFrame([(i, r.tolist(), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))], "sample_id long, spectrum array<double>, target double")


@pytest.mark.parametrize(("name", "params"), [("huber", {"delta": 0.3}), ("pseudo_huber", {"delta": 0.3}), ("cauchy", {"scale": 0.5})])
def test_reweighted_fit_equals_a_dense_one(spark, name, params):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 6)) + 5
    slopes = np.array([1.0, -2, 0.5, 0, 0, 3])
    y = x @ slopes + rng.normal(0, 0.1, 120)
    y[:8] += 40
    loss = losses.bind_training_loss(name, **params)
    got = pls.fit_reweighted(table(spark, x, y).repartition(3), 5, loss)
    beta, c = dense(x, y, 5)
    for _ in range(got.passes):  # the NumPy twin
        beta, c = dense(x, y, 5, loss.weight(y - x @ beta - c))
    assert got.converged and got.passes > 2
    assert np.allclose(got.model.coefficients, beta, atol=1e-7) and abs(got.model.intercept - c) < 1e-6
    plain = pls.fit(table(spark, x, y), 5)[4]
    clean = lambda m: np.abs((x @ m.coefficients + m.intercept - x @ slopes)[8:]).mean()
    assert clean(got.model) < clean(plain) / 3
    stage = ml.PLSRegression(nComponents=5, loss=name, lossParams=[f"{k}={v}" for k, v in params.items()])
    assert np.allclose(stage.fit(table(spark, x, y)).fitted.coefficients, got.model.coefficients, atol=1e-7)


def test_losses_and_their_names():
    r = np.linspace(-5, 5, 101)
    for name in ("squared", "huber", "pseudo_huber", "cauchy"):
        loss = losses.bind_training_loss(name)
        slope = (loss(r + 1e-6) - loss(r - 1e-6)) / 2e-6
        assert np.allclose(slope, loss.weight(r) * r, atol=1e-5) and loss(0.0) == 0
    for bad in (lambda: losses.bind_training_loss("unknown"), lambda: losses.bind_training_loss("huber", width=1), lambda: losses.bind_training_loss("huber", delta=0)):
        with pytest.raises(UnsupportedCapability):
            bad()
    losses.register_loss("half", lambda: losses.Loss("half", lambda r: r * r / 4, lambda r: np.full_like(r, 0.5)))
    assert losses.bind_training_loss("half")(2.0) == 1


def test_metrics_in_sql(spark):
    rows = [(1, 1.0, 2.0), (1, 2.0, 4.0), (1, 7.0, 6.5), (2, 3.0, 3.0), (2, None, 3.0), (2, 4.0, None), (3, None, None)]
    df = spark.createDataFrame(rows, "variant_idx int, target double, prediction double")
    df.createOrReplaceTempView("scored")
    names = ["rmse", "mae", "bias", "sep", "r2"]
    metrics.install(spark)
    a = metrics.evaluate(df, *names).orderBy("variant_idx").collect()
    calls = ", ".join(f"{n}(target, prediction) AS {n}" for n in names)
    b = spark.sql(f"SELECT variant_idx, {calls} FROM scored GROUP BY variant_idx ORDER BY variant_idx").collect()
    text = ", ".join(f"{metrics.metric_sql(n)} AS {n}" for n in names)
    c = spark.sql(f"SELECT variant_idx, {text} FROM scored GROUP BY variant_idx ORDER BY variant_idx").collect()
    near = lambda x, y: x == y or abs(x - y) < 1e-12
    assert all(near(x, y) and near(x, z) for r, s, t in zip(a, b, c, strict=True) for x, y, z in zip(r, s, t, strict=True))
    assert a[0].rmse == pytest.approx(np.sqrt((1 + 4 + 0.25) / 3)) and a[1].r2 is None and a[2].mae is None
    assert "Python" not in metrics.evaluate(df, *names)._jdf.queryExecution().toString()
    for bad in (lambda: metrics.evaluate(df, "unknown"), lambda: metrics.install(spark, "unknown"), lambda: metrics.metric_sql("unknown"), lambda: metrics.register_metric("a b", metrics.Metric((), "1"))):
        with pytest.raises(UnsupportedCapability):
            bad()


def test_wide_fit_equals_the_gram_fit(spark, data, monkeypatch):
    for one, two in zip(pls.fit(data, 6), pls.fit_wide(data.repartition(3), 6), strict=True):
        assert np.allclose(one.coefficients, two.coefficients, atol=1e-8) and one.intercept == pytest.approx(two.intercept, abs=1e-8)
    rng = np.random.default_rng(3)
    n, p = 40, 20_000
    t = rng.normal(size=(n, 3))
    x = t @ rng.normal(size=(3, p)) + 1e-2 * rng.normal(size=(n, p)) + 100
    y = t @ [1, 2, 3] + 7
    got = pls.fit(table(spark, x, y), 3)  # beyond the width of a table of moments
    assert np.abs(x @ got[2].coefficients + got[2].intercept - y).max() < 0.1
    xs, ys = (x - x.mean(0)) / x.std(0), (y - y.mean()) / y.std()
    deflated, left, beta_t = xs.copy(), ys.copy(), []
    for _ in range(3):  # the classical algorithm with deflation of the rows
        w = deflated.T @ left
        w /= np.linalg.norm(w)
        score = deflated @ w
        load, q = deflated.T @ score / (score @ score), left @ score / (score @ score)
        deflated, left = deflated - np.outer(score, load), left - q * score
        beta_t.append(ys - left)
    for k in range(3):
        mine = x @ got[k].coefficients + got[k].intercept
        assert np.allclose(mine, beta_t[k] * y.std() + y.mean(), atol=1e-6)
    with pytest.raises(DataError):
        pls.fit_wide(table(spark, np.where(x > 0, np.nan, 1)[:, :5], y), 2)


def test_split_of_a_table_is_made_once(spark, monkeypatch):
    from spectrine.operators import split

    made, real = [], split.kennard_stone_split
    monkeypatch.setattr(split, "kennard_stone_split", lambda *a, **k: made.append(1) or real(*a, **k))
    df = spark.createDataFrame([(i, [float(i % 7), float(i * i % 11)], 1.0) for i in range(30)], "sample_id long, spectrum array<double>, target double")
    first = sorted(map(tuple, ml.KennardStoneSplit(testSize=0.3).transform(df).collect()))
    again = sorted(map(tuple, ml.KennardStoneSplit(testSize=0.3).transform(df).collect()))
    assert first == again and len(first) == 30 and len(made) == 1
    other = ml.KennardStoneSplit(testSize=0.5).transform(df)
    assert len(made) == 2 and other.where("partition = 'test'").count() == 15
