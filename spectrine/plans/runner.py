"""Running a plan, replaying its model, and sessions that can be saved."""

from __future__ import annotations

import hashlib
import json
import os
import struct
import tempfile
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import DataError, SessionClosed, SpectrineError, UnsupportedCapability
from ..functions.columns import doubles, linear, snv
from ..functions.hashes import stable_hash
from ..functions.kernels import PlsModel, savgol_matrix
from ..functions.metrics import evaluate, register_metric
from ..operators import pls
from ..operators.matrix import require_rectangular
from ..operators.split import identity_split, kennard_stone_split
from ..shared import Tables
from .definition import Definition, Plan, compile_plan, load

__all__ = ["Model", "Result", "Session", "evaluate", "preflight", "publish", "register_metric", "run", "stable_hash"]

SESSION_SCHEMA = "spectrine.session.v1"
SESSION_BYTES = 64 * 1024 * 1024


def transform_column(x: Column, plan: Plan, width: int) -> Column:
    """The plan's transforms as one expression. Neighbouring linear filters are fused into one matrix."""
    out, matrix, offset = doubles(x), None, np.zeros(width)

    def flush(value: Column) -> Column:
        return value if matrix is None else linear(value, matrix, offset)

    for kind, params in plan.preprocessing:
        if kind == "SavitzkyGolay":
            m, c = savgol_matrix(width, *params)
            matrix, offset = (m, c) if matrix is None else (m @ matrix, m @ offset + c)
        elif kind == "StandardNormalVariate":
            out, matrix, offset = snv(flush(out)), None, np.zeros(width)
        else:
            raise UnsupportedCapability(f"no transform {kind}")
    return flush(out)


@dataclass(frozen=True)
class Model:
    """A fitted pipeline: how to transform a spectrum and predict from it."""

    plan: Plan
    pls: PlsModel

    @property
    def width(self) -> int:
        return len(self.pls.coefficients)

    def transform(self, df: DataFrame, *, spectrum: str = "spectrum") -> DataFrame:
        """Every row and column plus ``prediction``: a narrow plan, on tables and streams alike."""
        checked = F.when(F.size(spectrum) == self.width, doubles(F.col(spectrum))).otherwise(
            F.raise_error(F.format_string("%d values; the model takes %d", F.size(spectrum), F.lit(self.width)))
        )
        return df.withColumn("prediction", pls.predict(transform_column(checked, self.plan, self.width), self.pls))

    def to_dict(self) -> dict[str, Any]:
        return {
            "type": "PLSRegression", "n_components": self.pls.n_components, "coefficients": self.pls.coefficients.tolist(),
            "x_mean": self.pls.x_mean.tolist(), "y_mean": [self.pls.y_mean], "intercept": [self.pls.intercept],
            "n_features": self.width, "n_targets": 1,
            "preprocessing": [{"type": k, "params": list(p)} for k, p in self.plan.preprocessing],
        }

    @classmethod
    def from_dict(cls, doc: dict[str, Any]) -> Model:
        """Hydrate; ``xMean``/``yMean`` spellings and scalars for one-element vectors are accepted."""

        def vector(*names: str) -> np.ndarray:
            value = next((doc[n] for n in names if doc.get(n) is not None), None)
            if value is None:
                raise DataError(f"a model needs {names[0]}")
            return np.atleast_1d(np.asarray(value, dtype=float)).ravel()

        coefficients, x_mean, y_mean = vector("coefficients"), vector("x_mean", "xMean"), vector("y_mean", "yMean")
        if len(coefficients) != len(x_mean) or len(y_mean) != 1:
            raise DataError("coefficients, x_mean and y_mean do not fit together")
        if not all(np.isfinite(v).all() for v in (coefficients, x_mean, y_mean)):
            raise DataError("a model's numbers must be finite")
        steps = tuple((s["type"], tuple(s.get("params") or ())) for s in doc.get("preprocessing") or ())
        k = int(doc.get("n_components") or 1)
        return cls(Plan(None, steps, (k,)), PlsModel(k, coefficients, x_mean, float(y_mean[0])))

    def save(self, path: str | Path) -> None:
        publish(Path(path), dumps(self.to_dict()).encode())

    @classmethod
    def load(cls, path: str | Path) -> Model:
        return cls.from_dict(json.loads(Path(path).read_text("utf-8")))


@dataclass(frozen=True)
class Result:
    """Relational results of a run."""

    definition: Definition
    plan: Plan
    rows: int
    cols: int
    split: DataFrame
    predictions: DataFrame
    variants: DataFrame
    selected: dict[str, Any]
    model: Model

    @property
    def targets(self) -> DataFrame:
        """(sample_id, target) of the test rows."""
        return self.predictions.where("variant_idx = 0").select("sample_id", "target")

    @property
    def preprocessing(self) -> list[dict[str, Any]]:
        return [{"pos": i, "type": k, "params": list(p)} for i, (k, p) in enumerate(self.plan.preprocessing)]

    def evidence(self) -> dict[str, Any]:
        """Counts and figures of the run as plain values."""
        sizes = {r.partition: r.n for r in self.split.groupBy("partition").agg(F.count(F.lit(1)).alias("n")).collect()}
        variants = [r.asDict() for r in self.variants.orderBy("variant_idx").collect()]
        return {"name": self.definition.name, "rows": self.rows, "cols": self.cols, "split": sizes, "variants": variants, "selected": self.selected}


def run(source: Any, df: DataFrame) -> Result:
    """Parse, validate and plan; then split, transform, fit the sweep in one pass, predict and select.

    ``df`` is (sample_id, spectrum, target). Transforms are row-wise, so the table is
    transformed as it is read and the split joined afterwards; without a splitter no
    join is made at all, and the pass that fits also counts the rows and shows whether
    they are sound. Ragged spectra, nulls and values that are not finite are refused. A
    split is written to the shared folder, so it is computed once and nothing has to be held.
    """
    definition = load(source)
    plan = compile_plan(definition)
    k = max(plan.n_components)
    typed = df.select("sample_id", doubles(F.col("spectrum")).alias("spectrum"), F.col("target").cast("double").alias("target"))

    def ready(width: int) -> DataFrame:
        return typed.withColumn("spectrum", transform_column(F.col("spectrum"), plan, width))

    if plan.test_size is None:
        split = identity_split(typed)
        models, rows, width = _fit_all(df, ready, k)
        test = ready(width)
    else:
        rows, width = require_rectangular(df, target="target")
        split = Tables(df.sparkSession, "split").save(kennard_stone_split(typed, plan.test_size), "split")
        train, test = (ready(width).join(split.where(F.col("partition") == p).select("sample_id"), "sample_id") for p in ("train", "test"))
        models = pls.fit(train, k, width=width)
    swept = [models[k - 1] for k in plan.n_components]
    predictions = pls.predict_all(test, swept)
    variants = pls.rmse(predictions)
    selected = pls.select_best(variants).first().asDict()
    return Result(definition, plan, rows, width, split, predictions, variants, selected, Model(plan, swept[selected["variant_idx"]]))


def _fit_all(df: DataFrame, ready: Callable[[int], DataFrame], k: int) -> tuple[list[PlsModel], int, int]:
    """Models of all rows, their number and width, in one pass; what is wrong with rows is looked up only if something is."""
    first = df.select(F.size("spectrum").alias("w")).first()
    width = first.w if first else 0
    if width is None or not 0 < width <= pls.MAX_WIDTH:
        rows, width = require_rectangular(df, target="target")
        return pls.fit(ready(width), k, width=width), rows, width
    try:
        sums = pls.moments(ready(width), width)
        sound = bool(np.isfinite(sums).all())
    except (PySparkException, TypeError):
        sums, sound = None, False
    if not sound:
        require_rectangular(df, target="target")
    if sums is None or not sound:
        raise DataError("a transformed spectrum is not finite")
    return pls.models_from_moments(sums, k), round(sums[0, 0]), width


def dumps(value: Any) -> str:
    """Sorted keys, two spaces, no NaN."""
    return json.dumps(value, sort_keys=True, indent=2, allow_nan=False)


def definition_sha256(definition: Definition) -> str:
    return stable_hash(definition.as_dict())


def dataset_sha256(df: DataFrame) -> str:
    """SHA-256 over rows and columns (u64), then X and y (f64) in the order of ids, little-endian.

    Order matters, so rows stream through the driver one partition at a time.
    """
    rows, cols = require_rectangular(df)
    digest, targets = hashlib.sha256(struct.pack("<QQ", rows, cols)), bytearray()
    for row in df.select("sample_id", "spectrum", "target").orderBy("sample_id").toLocalIterator():
        digest.update(np.asarray(row.spectrum, dtype="<f8").tobytes())
        targets += struct.pack("<d", row.target)
    digest.update(bytes(targets))
    return digest.hexdigest()


def publish(path: Path, data: bytes) -> None:
    """Create a file in one step; an existing one is never replaced."""
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(fd, "wb") as out:
            out.write(data)
            out.flush()
            os.fsync(out.fileno())
        os.link(name, path)
    finally:
        os.unlink(name)


class Session:
    """A run that can be exported, replayed and closed."""

    def __init__(self, definition: Definition, model: Model, dataset: str, result: dict[str, Any]):
        self.definition, self._model, self.dataset_sha256, self.result = definition, model, dataset, result
        self._open = True

    @classmethod
    def start(cls, source: Any, df: DataFrame) -> Session:
        out = run(source, df)
        return cls(out.definition, out.model, dataset_sha256(df), out.evidence())

    @property
    def model(self) -> Model:
        if not self._open:
            raise SessionClosed("the session is closed")
        return self._model

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)

    def export(self) -> dict[str, Any]:
        return {
            "schema": SESSION_SCHEMA, "definition": self.definition.as_dict(), "model": self.model.to_dict(),
            "definition_sha256": definition_sha256(self.definition), "dataset_sha256": self.dataset_sha256, "result": self.result,
        }

    def save(self, path: str | Path) -> None:
        data = dumps(self.export()).encode()
        if len(data) > SESSION_BYTES:
            raise DataError("a session file holds at most 64 MiB")
        publish(Path(path), data)

    @classmethod
    def load(cls, path: str | Path, spark: SparkSession | None = None) -> Session:
        """Read and validate; with ``spark``, also predict one row of zeros with the model."""
        path = Path(path)
        if path.stat().st_size > SESSION_BYTES:
            raise DataError("a session file holds at most 64 MiB")
        doc = json.loads(path.read_text("utf-8"))
        if set(doc) != {"schema", "definition", "model", "definition_sha256", "dataset_sha256", "result"} or doc["schema"] != SESSION_SCHEMA:
            raise DataError("not a session of this version")
        definition = load(doc["definition"])
        if definition_sha256(definition) != doc["definition_sha256"]:
            raise DataError("the definition does not match its hash")
        if not {"rows", "cols", "split", "variants", "selected"} <= set(doc["result"]):
            raise DataError("the session's result lacks fields")
        model = Model.from_dict(doc["model"])
        if model.width != doc["result"]["cols"]:
            raise DataError("the model's width is not the session's")
        if spark is not None:
            preflight(spark, model)
        return cls(definition, model, doc["dataset_sha256"], doc["result"])

    def close(self) -> None:
        self._open = False

    def __enter__(self) -> Session:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def preflight(spark: SparkSession, model: Model) -> float:
    """The prediction of one row of zeros; fails where the model cannot be replayed."""
    zeros = spark.range(1).select(F.array_repeat(F.lit(0.0), model.width).alias("spectrum"))
    got = model.transform(zeros).first().prediction
    if got is None or not np.isfinite(got):
        raise SpectrineError("the model does not predict a finite value")
    return got
