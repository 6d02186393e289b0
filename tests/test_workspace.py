import pytest
from pyspark.sql import functions as F

from spectrine import queries
from spectrine.errors import DataError
from spectrine.plans import workspace as W
from spectrine.plans.runner import run
from spectrine.sources import datasets


@pytest.fixture(scope="module")
def data(spark):
    df = datasets.synthetic(spark).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", ["snv_pls", "methods"])
def test_save_reopen_rerun(spark, data, name, tmp_path):
    first = run(queries.DEFINITIONS[name], data)
    W.save_run(first, str(tmp_path / "a"), buckets=4)
    with W.open_run(spark, str(tmp_path / "a")) as a:
        again = a.rerun(data)
        W.save_run(again, str(tmp_path / "b"), buckets=4)
        other = run(queries.DEFINITIONS[name], data.withColumn("target", F.col("target") + (F.col("sample_id") == 3).cast("double")))
        W.save_run(other, str(tmp_path / "c"), buckets=4)
        assert a.evidence["rows"] == 40 and a.evidence["cols"] == 28
        assert sorted(map(tuple, a.predictions.collect())) == sorted(map(tuple, first.predictions.collect()))
        with W.open_run(spark, str(tmp_path / "b")) as b, W.open_run(spark, str(tmp_path / "c")) as c:
            got = {r.artifact: r for r in W.compare_saved(a, b).collect()}
            assert set(got) == {"predictions", "split", "variants", "model", "definition"} and all(r.agrees for r in got.values())
            assert got["predictions"].n == first.predictions.count() and got["split"].n == first.split.count()
            got = {r.artifact: r.agrees for r in W.compare_saved(a, c).collect()}
            assert got["definition"] and got["split"] and not got["predictions"] and not got["variants"] and not got["model"]
            plan = W.joined_predictions(a, b)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
    with pytest.raises(Exception, match="exist"):
        W.save_run(first, str(tmp_path / "a"), buckets=4)


def test_what_is_no_run_is_refused(spark, data, tmp_path):
    result = run(queries.DEFINITIONS["snv_pls"], data)
    W.save_run(result, str(tmp_path / "a"), buckets=2)
    W.save_run(result, str(tmp_path / "b"), buckets=3)
    with W.open_run(spark, str(tmp_path / "a")) as a, W.open_run(spark, str(tmp_path / "b")) as b, pytest.raises(DataError):
        W.compare_saved(a, b)
    text = spark.read.text(str(tmp_path / "a" / "run"), lineSep="\x00").first().value
    for change in (text.replace('"snv', '"x').replace(W.SCHEMA, "other"), "{", text.replace("StandardNormalVariate", "SNV", 1)):
        spark.createDataFrame([(change,)], "value string").write.mode("overwrite").text(str(tmp_path / "a" / "run"), lineSep="\x00")
        with pytest.raises(DataError):
            W.open_run(spark, str(tmp_path / "a"))
