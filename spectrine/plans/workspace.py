"""Runs kept as tables, to be reopened, rerun and compared.

A saved run is a folder that executors share: predictions, split and variants as Parquet,
definition, model and figures as one JSON document. Predictions are written in buckets of
(variant, id), sorted within them. A run that is opened declares its bucketing again, so two
runs of equal bucket count are compared bucket by bucket where the files lie, without a
shuffle of a single prediction.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DataError
from .definition import Definition, load
from .runner import Model, Result, definition_sha256, dumps, run

SCHEMA = "spectrine.run.v1"
BUCKETS = 32
KEYS = ("variant_idx", "sample_id")


def save_run(result: Result, path: str, *, buckets: int = BUCKETS) -> None:
    """Write a run; an existing folder is never written into."""
    spark = result.predictions.sparkSession
    name = f"spectrine_{uuid.uuid4().hex}"
    kinds = [[f.name, f.dataType.simpleString()] for f in result.predictions.schema]
    sorted_rows = result.predictions.repartition(buckets, *KEYS)  # as the buckets are dealt, so each is one file
    out = sorted_rows.write.format("parquet").mode("error").bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", f"{path}/predictions")
    out.saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    result.split.write.parquet(f"{path}/split")
    result.variants.write.parquet(f"{path}/variants")
    doc = {
        "schema": SCHEMA, "definition": result.definition.as_dict(), "definition_sha256": definition_sha256(result.definition),
        "model": result.model.to_dict(), "evidence": result.evidence(), "buckets": buckets, "columns": kinds,
        "split_columns": [[f.name, f.dataType.simpleString()] for f in result.split.schema],
    }
    # written last: a folder without it is no run
    spark.createDataFrame([(dumps(doc),)], "value string").coalesce(1).write.text(f"{path}/run", lineSep="\x00")


@dataclass(frozen=True)
class SavedRun:
    """A reopened run."""

    path: str
    definition: Definition
    model: Model
    evidence: dict[str, Any]
    buckets: int
    predictions: DataFrame
    split: DataFrame
    variants: DataFrame
    table: str

    def rerun(self, df: DataFrame) -> Result:
        """The same definition, run again."""
        return run(self.definition.as_dict(), df)

    def close(self) -> None:
        """Forget the table's declaration; files stay."""
        self.predictions.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")

    def __enter__(self) -> SavedRun:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def open_run(spark: SparkSession, path: str) -> SavedRun:
    """Read a saved run; a folder that holds none, or one that was changed by hand, is refused."""
    found = spark.read.text(f"{path}/run", lineSep="\x00").limit(2).collect()
    try:
        (doc,) = (json.loads(r.value) for r in found)
    except ValueError as error:
        raise DataError(f"{path} holds no run: {error}") from None
    if doc.get("schema") != SCHEMA:
        raise DataError("not a run of this version")
    definition = load(doc["definition"])
    if definition_sha256(definition) != doc["definition_sha256"]:
        raise DataError("the definition does not match its hash")
    name = f"spectrine_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{k}` {v}" for k, v in doc["columns"])
    keys = ", ".join(KEYS)
    place = f"{path}/predictions".replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(doc['buckets'])} BUCKETS LOCATION '{place}'")
    split_columns = ", ".join(f"`{k}` {v}" for k, v in doc["split_columns"])
    split = spark.read.schema(split_columns).parquet(f"{path}/split")
    variants = spark.read.parquet(f"{path}/variants")
    return SavedRun(path, definition, Model.from_dict(doc["model"]), doc["evidence"], doc["buckets"], spark.table(name), split, variants, name)


def joined_predictions(a: SavedRun, b: SavedRun) -> DataFrame:
    """(variant_idx, sample_id, target_a, target_b, prediction_a, prediction_b) of both runs' rows, nulls where one has none."""
    if a.buckets != b.buckets:
        raise DataError(f"{a.buckets} and {b.buckets} buckets; runs of one bucket count are compared in place")
    left, right = (
        r.predictions.select(*KEYS, F.col("target").alias(f"target_{s}"), F.col("prediction").alias(f"prediction_{s}")).hint("merge")
        for r, s in ((a, "a"), (b, "b"))
    )
    return left.join(right, list(KEYS), "full_outer")


def compare_saved(a: SavedRun, b: SavedRun, *, tolerance: float = 1e-10) -> DataFrame:
    """(artifact, n, n_unmatched, max_abs, agrees) for predictions, split, variants, model and definition."""
    spark = a.predictions.sparkSession
    both = joined_predictions(a, b)
    odd = F.col("prediction_a").isNull() | F.col("prediction_b").isNull()
    gap = F.greatest(F.abs(F.col("prediction_a") - F.col("prediction_b")), F.abs(F.col("target_a") - F.col("target_b")))
    figures = (F.count(F.lit(1)).alias("n"), F.count_if(odd).alias("n_unmatched"), F.coalesce(F.max(gap), F.lit(0.0)).alias("max_abs"))
    out = both.agg(*figures).select(F.lit("predictions").alias("artifact"), "n", "n_unmatched", "max_abs")
    rows = a.split.select("sample_id", "partition", F.lit(1).alias("_a")).join(b.split.select("sample_id", "partition", F.lit(1).alias("_b")), ["sample_id", "partition"], "full_outer")
    lost = F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("n_unmatched")
    out = out.unionByName(rows.agg(F.count(F.lit(1)).alias("n"), lost).select(F.lit("split").alias("artifact"), "n", "n_unmatched", F.lit(0.0).alias("max_abs")))
    sweep = a.variants.withColumnRenamed("rmse", "a").join(b.variants.withColumnRenamed("rmse", "b"), ["variant_idx", "n_components"], "full_outer")
    lost = F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("n_unmatched")
    largest = F.coalesce(F.max(F.abs(F.col("a") - F.col("b"))), F.lit(0.0)).alias("max_abs")
    out = out.unionByName(sweep.agg(F.count(F.lit(1)).alias("n"), lost, largest).select(F.lit("variants").alias("artifact"), "n", "n_unmatched", "max_abs"))
    m, n = a.model, b.model
    fits = m.width == n.width and m.plan.preprocessing == n.plan.preprocessing
    gap_ = float(max(np.abs(m.pls.coefficients - n.pls.coefficients).max(), abs(m.pls.intercept - n.pls.intercept))) if fits else 0.0
    same = definition_sha256(a.definition) == definition_sha256(b.definition)
    small = [("model", m.width, 0 if fits else 1, gap_), ("definition", 1, 0 if same else 1, 0.0)]
    out = out.unionByName(spark.createDataFrame(small, "artifact string, n long, n_unmatched long, max_abs double"))
    return out.withColumn("agrees", (F.col("n_unmatched") == 0) & (F.col("max_abs") <= tolerance))
