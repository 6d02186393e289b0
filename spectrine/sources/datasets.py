"""Datasets, predictions and evidence: generated, read and written."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DataError
from ..operators.matrix import SCHEMA, label_batch, label_partition, require_rectangular

#: Fixed values of the deterministic dataset.
ROWS, COLS = 40, 28
_MASK = 4294967295


def _noise(a: Column, b: Column) -> Column:
    """Hash noise in [-0.5, 0.5]: one step of a linear congruence on mixed integers. 64 bits suffice."""
    seed = ((a + 1) * F.lit(73856093)).bitwiseXOR((b + 1) * F.lit(19349663)).bitwiseAND(F.lit(_MASK))
    return (F.lit(1664525) * seed + F.lit(1013904223)).bitwiseAND(F.lit(_MASK)) / F.lit(float(_MASK)) - F.lit(0.5)


def synthetic(spark: SparkSession, rows: int = ROWS, cols: int = COLS) -> DataFrame:
    """(sample_id, spectrum, target): waves, a slope, four offsets and noise; deterministic."""
    r = F.col("sample_id")

    def cell(c: Column) -> Column:
        return (
            0.6 * F.sin(r / 5.0 + c / 7.0) + 0.25 * F.cos(r / 6.0 - c / 11.0) + 0.002 * (F.lit(900.0) + 8.0 * c)
            + (F.pmod(r, F.lit(4)) - 1.5) * 0.03 + 0.12 * _noise(r, c) + 0.03 * F.sin((r + 1) * (c + 2) / 13.0)
        )

    places = F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long"))
    spectrum = F.transform(places, cell)

    def part(acc: Column, c: Column) -> Column:
        weight = F.when(c < 14, F.lit(0.04)).otherwise(F.lit(-0.025))
        return acc + (F.get("spectrum", c.cast("int")) * weight + 0.01 * _noise(c, r))

    target = F.aggregate(places, F.lit(0.0), part) + 0.2 * F.sin(r / 3.0) + 0.015 * r
    return spark.range(rows).withColumnRenamed("id", "sample_id").withColumn("spectrum", spectrum).withColumn("target", target)


def read_json_dataset(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, spectrum, target) from a document {X, y, rows?, cols?}, X nested or flat."""
    raw = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    nested = raw.schema["X"].dataType.simpleString() == "array<array<string>>"
    schema = f"X {'array<array<double>>' if nested else 'array<double>'}, y array<double>, rows int, cols int, n_samples int, n_features int"
    doc = spark.read.option("multiLine", True).schema(schema).json(path)
    if nested:
        x = F.col("X")
    else:
        cols = F.coalesce("cols", "n_features")
        n = F.coalesce("rows", "n_samples")
        fits = F.coalesce((n > 0) & (cols > 0) & (n * cols == F.size("X")), F.lit(False))
        flat = F.when(fits, F.col("X")).otherwise(F.raise_error(F.lit("a flat X needs rows * cols values and both counts")))
        x = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(flat, i * cols + 1, cols))
    rows = F.when(F.size(x) == F.size("y"), F.arrays_zip(x.alias("x"), F.col("y").alias("y"))).otherwise(
        F.raise_error(F.lit("X and y differ in length"))
    )
    out = doc.select(F.posexplode(rows).alias("p", "z"))
    return out.select(F.col("p").cast("long").alias("sample_id"), F.col("z.x").alias("spectrum"), F.col("z.y").alias("target"))


def write_csv_triple(df: DataFrame, headers: Sequence, path: str, *, target: str = "moisture") -> None:
    """X, Y and M folders of ';'-separated files for (observation_id, position, spectrum, target)."""
    _, width = require_rectangular(df)
    if width != len(headers):
        raise DataError(f"{len(headers)} headers for {width} columns")
    cells = [F.get("spectrum", F.lit(i)).alias(str(h)) for i, h in enumerate(headers)]
    option = {"sep": ";", "header": True, "mode": "errorifexists"}
    df.select("observation_id", *cells).write.csv(f"{path}/X", **option)
    df.select("observation_id", F.col("target").alias(target)).write.csv(f"{path}/Y", **option)
    meta = df.select(
        F.lit("dataset").alias("dataset_id"), "observation_id", label_partition(F.col("position")).alias("split_original"), label_batch(F.col("position")).alias("batch")
    )
    meta.write.csv(f"{path}/M", **option)


def csv_headers(spark: SparkSession, path: str) -> list[str]:
    """The feature headers of a triple, in order, from the first line of X alone."""
    names = spark.read.csv(f"{path}/X", sep=";", header=True).columns
    if not names or names[0] != "observation_id":
        raise DataError("X needs observation_id as its first column")
    return names[1:]


def read_csv_triple(spark: SparkSession, path: str, headers: Sequence | None = None, *, target: str = "moisture") -> DataFrame:
    """(observation_id, spectrum, target, split_original, batch): X, Y and M joined on the id.

    Without ``headers`` those of the files are taken; with some of them only their columns are parsed. Files
    whose header differs from what is asked are refused when they are read.
    """
    found = csv_headers(spark, path)
    headers = found if headers is None else [str(h) for h in headers]
    if lost := [h for h in headers if h not in set(found)]:
        raise DataError("X lacks the columns " + ", ".join(lost))
    option = {"sep": ";", "header": True}
    cells = ", ".join(f"`{h}` double" for h in found)
    x = spark.read.csv(f"{path}/X", schema=f"observation_id string, {cells}", **option)
    y = spark.read.csv(f"{path}/Y", schema=f"observation_id string, `{target}` double", **option)
    m = spark.read.csv(f"{path}/M", schema="dataset_id string, observation_id string, split_original string, batch string", **option)
    x = x.select("observation_id", F.array(*[F.col(f"`{h}`") for h in headers]).alias("spectrum"))
    return x.join(y.withColumnRenamed(target, "target"), "observation_id").join(m.drop("dataset_id"), "observation_id")


#: Columns of a table of predictions with one row per model, partition and fold.
PREDICTIONS = {
    "model_name": "string", "partition": "string", "fold_id": "string", "sample_indices": "array<bigint>",
    "y_true": "array<double>", "y_pred": "array<double>",
}


def read_predictions(spark: SparkSession, path: str, required: Sequence[str] = tuple(PREDICTIONS)) -> DataFrame:
    """A Parquet table of predictions; missing columns are an error before any row is read."""
    df = spark.read.parquet(path)
    if lost := [c for c in required if c not in df.columns]:
        raise DataError("predictions lack the columns " + ", ".join(lost))
    return df


def prediction_frame(predictions: DataFrame, *, scenario: str, runtime: str = "spark") -> DataFrame:
    """The exported frame: scenario, runtime, sample, target, prediction, residual and component count."""
    return predictions.select(
        F.lit(scenario).alias("scenario_id"), F.lit(runtime).alias("runtime"), F.col("sample_id").cast("long").alias("sample_index"),
        F.col("sample_id").cast("string").alias("sample_id"), "target", "prediction",
        (F.col("prediction") - F.col("target")).alias("residual"), "n_components",
    )


def write_predictions(predictions: DataFrame, path: str, **names: str) -> None:
    prediction_frame(predictions, **names).write.mode("errorifexists").parquet(path)


def write_evidence(path: str | Path, value: Any) -> None:
    """A small JSON file: sorted keys, two spaces, no NaN."""
    Path(path).write_text(json.dumps(value, sort_keys=True, indent=2, allow_nan=False) + "\n", "utf-8")


__all__ = [
    "COLS", "PREDICTIONS", "ROWS", "SCHEMA", "prediction_frame", "read_csv_triple", "read_json_dataset", "read_predictions",
    "synthetic", "write_csv_triple", "write_evidence", "write_predictions",
]
