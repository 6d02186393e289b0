"""What this engine can do, as tables."""

from __future__ import annotations

import importlib
import importlib.util
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from .errors import UnsupportedCapability
from .plans.definition import BELOW_ROOT, WHOLE

#: Capability levels, weakest first. Fixed values.
LEVELS = ("metadata", "plan", "execute-local", "execute-remote", "parity-validated")
SURFACES = ("python", "sql", "streaming")



def _classes(operator: str) -> list[str]:
    """The class names of the plan language that stand for an operator, without their packages."""
    names = (BELOW_ROOT | WHOLE).items()
    return sorted({name.rsplit(".", 1)[1] for name, found in names if found == operator})


#: Ids, kinds and ports of the contract. Class names come from the plan language.
_CONTROLLERS = (
    ("split.kennard_stone", "splitter", "Kennard-Stone split", _classes("KennardStone"), ["X"], ["train_indices", "test_indices"], ["test_size"], []),
    ("preprocess.snv", "transform", "Standard normal variate", _classes("StandardNormalVariate"), ["X"], ["X_transformed"], [], []),
    (
        "preprocess.savgol", "transform", "Savitzky-Golay", _classes("SavitzkyGolay"), ["X"], ["X_transformed"],
        ["window_length", "polyorder", "deriv", "mode", "cval"], [],
    ),
    ("model.pls_regression", "model", "PLS regression", _classes("PLSRegression"), ["X", "y"], ["predictions", "model"], ["n_components", "_range_"], []),
    (
        "pipeline.spectral", "pipeline", "Spectral pipeline", [], ["pipeline", "dataset"], ["execution_result", "predictions", "model"], [],
        ["split.kennard_stone", "preprocess.snv", "preprocess.savgol", "model.pls_regression"],
    ),
)
_RUNTIMES = (
    ("python", "parity-validated", "spectrine.plans.runner.run", True, "spectrine.plans.runner.Model.transform"),
    ("sql", "metadata", None, False, None),
    ("streaming", "metadata", None, True, "spectrine.streaming.score_stream"),
)
_ARTIFACTS = (
    ("model.json", "spectrine.model.v1", "execute-local", []),
    ("session.json", "spectrine.session.v1", "execute-local", []),
    ("archive.v1", "spectrine.archive.v1", "execute-local", ["extensions"]),
    ("archive.v2", "spectrine.archive.v2", "execute-local", ["extensions"]),
    ("run", "spectrine.run.v1", "execute-local", []),
)
_CONSTANTS = {"ROBUSTNESS_SCENARIO_DISTRIBUTIONS": ["normal", "uniform"]}
_MODULES = (
    ("engine", "Query engine", "pyspark"),
    ("arrays", "Array kernels", "numpy"),
    ("exchange", "Columnar exchange", "pyarrow"),
    ("definitions", "YAML definitions", "yaml"),
    ("frames", "Data frames for grouped operators", "pandas"),
    ("oracle", "Oracle of the test queries", "duckdb"),
)


def controllers(spark: SparkSession) -> DataFrame:
    schema = (
        "id string, kind string, label string, operator_classes array<string>, inputs array<string>, outputs array<string>, "
        "parameters array<string>, composes array<string>"
    )
    return spark.createDataFrame(list(_CONTROLLERS), schema)


def runtimes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(_RUNTIMES), "surface string, pipeline_execution string, entrypoint string, model_predict boolean, predict_entrypoint string"
    )


def artifacts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(_ARTIFACTS), "id string, schema string, level string, optional_fields array<string>")


def levels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(LEVELS)), "rank int, level string")


def constants(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, v) for k, v in _CONSTANTS.items()], "name string, entries array<string>")


def modules(spark: SparkSession) -> DataFrame:
    """(key, role, import_name, available) of the packages that operators build on."""
    rows = [(k, role, name, importlib.util.find_spec(name) is not None) for k, role, name in _MODULES]
    return spark.createDataFrame(rows, "key string, role string, import_name string, available boolean")


def manifest() -> dict:
    """The capability tables as one document."""
    return {
        "levels": list(LEVELS), "surfaces": list(SURFACES), "controllers": [c[0] for c in _CONTROLLERS],
        "artifacts": [a[0] for a in _ARTIFACTS], "constants": {k: list(v) for k, v in _CONSTANTS.items()},
    }


def require_module(key: str) -> ModuleType:
    """Import a module of the registry; an unknown or absent one is refused by name."""
    name = next((n for k, _, n in _MODULES if k == key), None)
    if name is None:
        raise UnsupportedCapability(f"no module is registered as {key!r}")
    try:
        return importlib.import_module(name)
    except ImportError as error:
        raise UnsupportedCapability(f"{key} needs the package {name}, which cannot be imported") from error


def export_gaps(expected: list[str], exported: list[str]) -> dict[str, list[str]]:
    """Names missing from and names beyond an expected export list."""
    return {"missing": sorted(set(expected) - set(exported)), "extra": sorted(set(exported) - set(expected))}
