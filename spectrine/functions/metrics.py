"""Metrics by name, as aggregates over a target and a prediction.

A metric is declared by means of SQL terms in ``y`` and ``p`` and a SQL expression over
those means. It so stays built-in aggregates, with partial sums in every task, wherever
it is used: :func:`metric` gives the Column, :func:`metric_sql` the text for a query.
:func:`install` makes single calls such as ``rmse(target, prediction)`` possible in
``spark.sql``; those are aggregates in Python, which bring a group's rows into one
task, so for large groups the text is the form to use.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import UnsupportedCapability


@dataclass(frozen=True)
class Metric:
    """Means of ``terms`` (SQL in y and p), ``finish`` (SQL over the terms' names), and the same of two arrays."""

    terms: tuple[tuple[str, str], ...]
    finish: str
    of_arrays: Callable[[np.ndarray, np.ndarray], float] | None = None
    larger_is_better: bool = False


_METRICS: dict[str, Metric | Callable[[Column, Column], Column]] = {}


def register_metric(name: str, metric: Metric | Callable[[Column, Column], Column]) -> None:
    """Register a metric, or an aggregate over (target, prediction) columns, under ``name``."""
    if not re.fullmatch(r"[a-z]\w*", name):
        raise UnsupportedCapability(f"{name!r} is no name of a metric")
    _METRICS[name] = metric


def find_metric(name: str) -> Metric | Callable[[Column, Column], Column]:
    if name not in _METRICS:
        raise UnsupportedCapability(f"no metric {name}; known are {', '.join(sorted(_METRICS))}")
    return _METRICS[name]


def _declared(name: str) -> Metric:
    found = find_metric(name)
    if not isinstance(found, Metric):
        raise UnsupportedCapability(f"metric {name} has no SQL form")
    return found


def _put(text: str, values: dict[str, str]) -> str:
    """``text`` with whole names replaced."""
    return re.sub(r"\b(" + "|".join(map(re.escape, values)) + r")\b", lambda m: values[m[0]], text)


def metric_sql(name: str, target: str = "target", prediction: str = "prediction") -> str:
    """The metric as a SQL aggregate over two SQL expressions."""
    found = _declared(name)
    at = {"y": f"CAST(({target}) AS DOUBLE)", "p": f"CAST(({prediction}) AS DOUBLE)"}
    both = f"{at['y']} IS NOT NULL AND {at['p']} IS NOT NULL"  # a row counts in all terms or in none
    return _put(found.finish, {term: f"avg(CASE WHEN {both} THEN {_put(sql, at)} END)" for term, sql in found.terms})


def metric(name: str, target: str = "target", prediction: str = "prediction") -> Column:
    """The metric as an aggregate Column over two columns."""
    found = find_metric(name)
    if isinstance(found, Metric):
        return F.expr(metric_sql(name, f"`{target}`", f"`{prediction}`"))
    return found(F.col(target), F.col(prediction))


def evaluate(predictions: DataFrame, *names: str, by: str = "variant_idx", target: str = "target", prediction: str = "prediction") -> DataFrame:
    """(``by``, one column a metric)."""
    for name in names:
        find_metric(name)
    return predictions.groupBy(by).agg(*[metric(n, target, prediction).alias(n) for n in names])


def install(spark: SparkSession, *names: str) -> None:
    """Register metrics (by default all that have a NumPy form) as SQL aggregates of (target, prediction) in this session.

    Rows with a null are left out; a group without other rows, and a value that is not a number, give null.
    """
    for name in names or [n for n, m in _METRICS.items() if isinstance(m, Metric) and m.of_arrays]:
        found = _declared(name)
        if found.of_arrays is None:
            raise UnsupportedCapability(f"metric {name} has no NumPy form")
        spark.udf.register(name, F.arrow_udf(_aggregate(found.of_arrays), "double"))


def _aggregate(of_arrays: Callable[[np.ndarray, np.ndarray], float]) -> Callable:
    def run(target: pa.Array, prediction: pa.Array) -> float:
        both = target.is_valid().to_numpy(zero_copy_only=False) & prediction.is_valid().to_numpy(zero_copy_only=False)
        y, p = (x.to_numpy(zero_copy_only=False).astype(float)[both] for x in (target, prediction))
        got = of_arrays(y, p) if len(y) else np.nan
        return None if np.isnan(got) else float(got)

    run.__annotations__ = {"target": pa.Array, "prediction": pa.Array, "return": float}
    return run


def _r2(y: np.ndarray, p: np.ndarray) -> float:
    spread = np.mean(y * y) - np.mean(y) ** 2
    return 1 - np.mean((p - y) ** 2) / spread if spread else np.nan


register_metric("rmse", Metric((("m", "(p - y) * (p - y)"),), "sqrt(m)", lambda y, p: np.sqrt(np.mean((p - y) ** 2))))
register_metric("mae", Metric((("m", "abs(p - y)"),), "m", lambda y, p: np.mean(np.abs(p - y))))
register_metric("bias", Metric((("m", "p - y"),), "m", lambda y, p: np.mean(p - y)))
register_metric("sep", Metric((("m", "(p - y) * (p - y)"), ("b", "p - y")), "sqrt(CASE WHEN m < b * b THEN 0 ELSE m - b * b END)", lambda y, p: np.std(p - y)))
register_metric("r2", Metric((("m", "(p - y) * (p - y)"), ("s", "y * y"), ("a", "y")), "1 - m / nullif(s - a * a, 0)", _r2, larger_is_better=True))
