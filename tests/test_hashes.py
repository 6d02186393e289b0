import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spectrine.functions.hashes import canonical, stable_hash, stable_hash_of


def test_columns_hash_as_values(spark):
    rows = [
        (1, "é\"\n", [1.5, None], {"b": [1], "a": None}, (True, ["x", None])),
        (2, None, None, None, None),
        (3, "", [], {}, (None, [])),
    ]
    schema = "n long, t string, xs array<double>, m map<string,array<int>>, s struct<b: boolean, a: array<string>>"
    df = spark.createDataFrame(rows, schema)
    got = df.select("n", stable_hash_of(F.struct("s", "n", "t", "xs", "m")).alias("h"), stable_hash_of(F.col("m")).alias("m")).orderBy("n").collect()
    for r, (n, t, xs, m, s) in zip(got, rows, strict=True):
        value = {"n": n, "t": t, "xs": xs, "m": m, "s": None if s is None else {"b": s[0], "a": s[1]}}
        assert r.h == stable_hash(value) and r.m == stable_hash(m)
    assert canonical({"b": 1, "a": [None, "ü"]}) == '{"a":[null,"ü"],"b":1}' and json.loads(canonical({"x": 1.5})) == {"x": 1.5}
    for bad in ("current_date()", "map(1, 2)", "cast('nan' as double)"):
        with pytest.raises(PySparkException):
            spark.range(1).select(stable_hash_of(F.expr(bad))).collect()
