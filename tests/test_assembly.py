import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrine.errors import DataError
from spectrine.operators import audit, matrix
from spectrine.sources import datasets


def test_sparse_assembly_of_five_thousand_headers(spark):
    rng = random.Random(1)
    cells = {(f"k{rng.randrange(40)}", f"h{rng.randrange(5000):04d}"): rng.random() for _ in range(9000)}
    rows = [(k, h, v) for (k, h), v in cells.items()] + [("k0", "h0001", 0.5), ("k1", "h0002", None), ("none", None, 1.0), (None, "h0003", 2.0)]
    df = spark.createDataFrame(rows, "key string, header string, value double").repartition(5)
    got = {r.key: r.spectrum for r in matrix.assemble_sparse(df, "key", "header", "value").collect()}
    headers = sorted({h for _, h, _ in rows if h})
    want = {k: np.zeros(len(headers)) for k, _, _ in rows}
    for k, h, v in rows:
        if h and v is not None:
            want[k][headers.index(h)] += v
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_sparse_assembly_by_given_places(spark):
    df = spark.createDataFrame([(1, "a", "x", 1.0), (1, "a", "y", 2.0), (2, "b", "z", 3.0)], "spectrum int, j string, header string, value double")
    places = spark.createDataFrame([("y", 0), ("x", 3)], "header string, j int")
    got = matrix.assemble_sparse(df, ["spectrum", "j"], "header", "value", places=places, fill=-1.0)
    rows = {(r[0], r[1]): list(r[2]) for r in got.collect()}
    assert rows == {(1, "a"): [2.0, -1.0, -1.0, 1.0], (2, "b"): [-1.0] * 4}
    assert matrix.assemble_sparse(df.limit(0), "j", "header", "value").count() == 0


def test_positions_keep_columns_of_their_inner_names(spark):
    df = spark.createDataFrame([(3, 7, 8, 9), (1, 4, 5, 6)], "sample_id long, _bucket int, _at int, _start int")
    got = [tuple(r) for r in matrix.with_position(df).orderBy("position").collect()]
    assert got == [(1, 4, 5, 6, 0), (3, 7, 8, 9, 1)]


def coverage(slices):
    end, overlaps, gaps, covered = None, 0, 0, 0
    for a, b in sorted(slices):
        if end is not None:
            overlaps += a < end
            gaps += a > end
        covered += max(0, b - max(a, end if end is not None else a))
        end = b if end is None else max(end, b)
    return len(slices), min(s[0] for s in slices) == 0, end == 500, overlaps, gaps, covered


@pytest.mark.parametrize("parts", [1, 7])
def test_coverage_of_nested_slices(spark, parts):
    rng = random.Random(parts)
    keys = {k: [(a := rng.randrange(490), a + rng.randrange(1, 11)) for _ in range(n)] for k, n in (("big", 3000), ("small", 5), (None, 40))}
    keys |= {"nested": [(0, 500), (10, 20), (30, 40)], "exact": [(i, i + 1) for i in range(500)], "twice": [(0, 250), (0, 250), (250, 500)]}
    rows = [(k, a, b, 500) for k, v in keys.items() for a, b in v]
    df = spark.createDataFrame(rows, "range string, a long, b long, w long").repartition(3)
    got = audit.interval_coverage(df, keys=["range"], start="a", stop="b", width="w", parts=parts).collect()
    assert {r["range"]: tuple(r)[1:] for r in got} == {k: coverage(v) for k, v in keys.items()}


def test_a_key_of_a_million_slices_is_scanned_in_parts(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), F.col("id").alias("a"), (F.col("id") + 2).alias("b"), F.lit(1_000_001).alias("w"))
    got = audit.interval_coverage(df, keys=["k"], start="a", stop="b", width="w", parts=16).first()
    assert tuple(got) == (1, 1_000_000, True, True, 999_999, 0, 1_000_001)


def test_pairs_of_runs_by_slots(spark):
    rng = random.Random(3)
    cells = {(rng.choice("abcd"), rng.randrange(50)): rng.random() for _ in range(150)}
    df = spark.createDataFrame([(r, k, v) for (r, k), v in cells.items()] + [(None, 1, 1.0), ("a", None, 2.0)], "run string, k int, v double")
    one, two = (sorted(tuple(x) for x in f(df, "run", "k", "v").collect()) for f in (audit.pairwise, audit.pairwise_slots))
    assert one == two and len(one) == 6
    plan = audit.pairwise_slots(df, "run", "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert audit.pairwise_slots(df.where("run = 'a'"), "run", "k", "v").count() == 0


def test_differences_of_nearly_equal_runs(spark):
    base = spark.range(5000).select(F.col("id").alias("sample_id"), (F.col("id") * 0.5).alias("target"), (F.col("id") * 0.25).alias("prediction"))
    assert audit.run_differences(base, base.repartition(7)).count() == 0
    moved = F.when(F.col("sample_id") == 17, 100.0).when(F.col("sample_id") == 18, None).otherwise(F.col("prediction"))
    other = base.where("sample_id <> 40").withColumn("prediction", moved).union(spark.createDataFrame([(9999, 1.0, 1.0)], base.schema))
    got = {r.sample_id: (r.kind, r.max_abs) for r in audit.run_differences(base, other).collect()}
    assert got == {17: ("changed", 100 - 4.25), 18: ("changed", None), 40: ("only_a", None), 9999: ("only_b", None)}
    report = audit.difference_report(base, other).first()
    assert (report.n_only_a, report.n_only_b, report.n_changed, report.n_beyond, report.agrees) == (1, 1, 2, 2, False)
    assert (list(report.ids_only_a), list(report.ids_only_b), list(report.ids_changed)) == ([40], [9999], [17, 18])
    assert audit.difference_report(base, base).first().agrees


def test_headers_of_a_triple_are_found(spark, tmp_path):
    df = datasets.synthetic(spark, 12, 6)
    df = matrix.with_position(df).withColumn("observation_id", F.concat(F.lit("o"), F.col("sample_id").cast("string")))
    names = ["900", "908.5", "a b", "916", "924", "932"]
    datasets.write_csv_triple(df, names, str(tmp_path / "t"))
    assert datasets.csv_headers(spark, str(tmp_path / "t")) == names
    whole = {r.observation_id: r.spectrum for r in datasets.read_csv_triple(spark, str(tmp_path / "t")).collect()}
    some = {r.observation_id: r.spectrum for r in datasets.read_csv_triple(spark, str(tmp_path / "t"), ["924", "a b"]).collect()}
    assert all(some[k] == [whole[k][4], whole[k][2]] for k in whole) and len(whole) == 12
    with pytest.raises(DataError):
        datasets.read_csv_triple(spark, str(tmp_path / "t"), ["900", "901"])
