"""Partial least squares from one pass over the data.

The pass computes the moments of [1 | x | y]: each batch is one matrix product, each
partition one partial sum, and partial sums are added by a distributed aggregation
of (p + 2)^2 cells. A short recurrence on the driver then gives the models of all
component counts at once, so a sweep costs no further pass. Spectra too wide for such a
table are fitted without it, with a pass a component; a training loss other than least
squares takes a weighted pass a step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DataError
from ..functions.columns import dot, doubles
from ..functions.kernels import PlsModel, centres, pls_from_moments, pls_slopes
from ..functions.losses import Loss

MAX_WIDTH = 4_000


def _cells(df: DataFrame, spectrum: str, target: str) -> tuple[DataFrame, np.ndarray]:
    """(x, y) of every row, and the first row's values, by which sums are shifted.

    The shift keeps sums well conditioned when means are large against deviations.
    """
    cells = df.select(doubles(F.col(spectrum)).alias("x"), F.col(target).cast("double").alias("y"))
    pilot = cells.first()
    if pilot is None:
        raise DataError("no rows to fit")
    return cells, np.r_[np.asarray(pilot.x, float), np.nan if pilot.y is None else float(pilot.y)]


def _sums(cells: DataFrame, width: int, size: int, of_batch: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of ``of_batch(x, y)``, ``size`` numbers: one partial sum a task, then a distributed one."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x, y = batch.column(0), batch.column(1)
            if not len(y):
                continue
            values = x.flatten().to_numpy(zero_copy_only=False)
            if x.null_count or len(values) != len(y) * width:
                raise ValueError(f"spectra must all have {width} values")
            total += of_batch(values.reshape(-1, width), y.to_numpy(zero_copy_only=False).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["m"])

    sums = cells.mapInArrow(partial, "m array<double>").select(F.posexplode("m").alias("cell", "v")).groupBy("cell").agg(F.sum("v").alias("v"))
    out = np.zeros(size)
    for row in sums.collect():  # ``size`` rows, whatever the number of rows summed
        out[row.cell] = row.v
    return out


def moments(df: DataFrame, width: int, *, spectrum: str = "spectrum", target: str = "target", weigh: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """Sum of outer products of (1, x - shift, y - shift) and, in the last row, the shift that was used.

    ``weigh(x, y)`` gives the weight of each row of a batch; without it all weigh 1.
    """
    if width > MAX_WIDTH:
        raise DataError(f"{width} columns; moments are kept for at most {MAX_WIDTH}")
    cells, shift = _cells(df, spectrum, target)
    size = width + 2

    def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = np.empty((len(y), size))
        z[:, 0] = 1.0
        z[:, 1:-1] = x - shift[:-1]
        z[:, -1] = y - shift[-1]
        left = z if weigh is None else z * weigh(x, y)[:, None]
        return (left.T @ z).ravel()

    out = _sums(cells, width, size * size, products)
    return np.vstack([out.reshape(size, size), np.r_[0.0, shift]])


def models_from_moments(m: np.ndarray, k_max: int) -> list[PlsModel]:
    shift, m = m[-1, 1:], m[:-1]
    shifted = pls_from_moments(m[0, 0], m[0, 1:-1], m[0, -1], m[1:-1, 1:-1], m[1:-1, -1], m[-1, -1], k_max)
    return [PlsModel(s.n_components, s.coefficients, s.x_mean + shift[:-1], s.y_mean + float(shift[-1])) for s in shifted]


def _width(df: DataFrame, spectrum: str, width: int | None) -> int:
    if width is not None:
        return width
    first = df.select(F.size(spectrum).alias("w")).first()
    if first is None:
        raise DataError("no rows to fit")
    return first.w


def fit(df: DataFrame, k_max: int, *, spectrum: str = "spectrum", target: str = "target", width: int | None = None) -> list[PlsModel]:
    """Models with 1..k_max components. Nulls and values that are not finite are an error.

    Up to ``MAX_WIDTH`` columns one pass sums the moments; wider spectra take :func:`fit_wide`.
    """
    width = _width(df, spectrum, width)
    if width > MAX_WIDTH:
        return fit_wide(df, k_max, spectrum=spectrum, target=target, width=width)
    sums = moments(df, width, spectrum=spectrum, target=target)
    if not np.isfinite(sums).all():
        raise DataError("a spectrum or target is null or not finite")
    return models_from_moments(sums, k_max)


def fit_wide(df: DataFrame, k_max: int, *, spectrum: str = "spectrum", target: str = "target", width: int | None = None) -> list[PlsModel]:
    """The same models without a table of width^2 cells: memory and shuffle grow with the width alone.

    The recurrence needs the covariance matrix only as a factor of vectors. One pass
    sums the columns, their squares and their products with the target; each component
    then takes a pass that sums x (x . r). Passes read the rows again, so persist ``df`` where it is dear.
    """
    width = _width(df, spectrum, width)
    cells, shift = _cells(df, spectrum, target)

    def columns(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x, y = x - shift[:-1], y - shift[-1]
        return np.r_[len(y), y.sum(), y @ y, x.sum(0), np.einsum("ij,ij->j", x, x), y @ x]

    sums = _sums(cells, width, 3 + 3 * width, columns)
    if not np.isfinite(sums).all():
        raise DataError("a spectrum or target is null or not finite")
    n, sy, syy = sums[:3]
    sx, sxx, sxy = sums[3:].reshape(3, width)
    x_mean, y_mean, x_std, y_std = centres(n, sx, sy, sxx, syy, k_max)
    s = (sxy - n * x_mean * y_mean) / (x_std * y_std)
    middle = x_mean + shift[:-1]

    def times(r: np.ndarray) -> np.ndarray:
        v = r / x_std

        def products(x: np.ndarray, _: np.ndarray) -> np.ndarray:
            centred = x - middle
            return centred.T @ (centred @ v)

        return _sums(cells, width, width, products) / x_std

    slopes = pls_slopes(s, times, k_max)
    return [PlsModel(k, y_std * beta / x_std, middle, float(y_mean + shift[-1])) for k, beta in enumerate(slopes, 1)]


@dataclass(frozen=True)
class Reweighted:
    """A model fitted under a loss: passes used, and whether its slopes have settled."""

    model: PlsModel
    passes: int
    converged: bool


def fit_reweighted(
    df: DataFrame, k: int, loss: Loss, *, spectrum: str = "spectrum", target: str = "target", width: int | None = None, passes: int = 50, tolerance: float = 1e-9
) -> Reweighted:
    """A model of ``k`` components under a training loss, by repeated weighted fits.

    It starts from the least-squares model. Each pass weighs a row by the loss's weight
    of its residual under the model before, where it is read, and sums the weighted
    moments; nothing is stored for a row. It ends when no prediction coefficient moves by more than
    ``tolerance`` of the largest.
    """
    width = _width(df, spectrum, width)
    if passes < 1:
        raise DataError("a fit needs a pass")
    model = fit(df, k, spectrum=spectrum, target=target, width=width)[k - 1]
    for used in range(1, passes + 1):
        slopes, intercept = model.coefficients, model.intercept

        def weigh(x: np.ndarray, y: np.ndarray, slopes=slopes, intercept=intercept) -> np.ndarray:
            return loss.weight(y - (x @ slopes + intercept))

        sums = moments(df, width, spectrum=spectrum, target=target, weigh=weigh)
        if not np.isfinite(sums).all() or sums[0, 0] <= 0:
            raise DataError(f"the weights of loss {loss.name} leave nothing to fit")
        model = models_from_moments(sums, k)[k - 1]
        moved = max(np.abs(model.coefficients - slopes).max(), abs(model.intercept - intercept))
        if moved <= tolerance * max(np.abs(slopes).max(), abs(intercept), 1e-300):
            return Reweighted(model, used, True)
    return Reweighted(model, passes, False)


def predict(spectrum: Column, model: PlsModel) -> Column:
    """Affine prediction; a spectrum of another width is an error."""
    width = len(model.coefficients)
    checked = F.when(F.size(spectrum) == width, doubles(spectrum)).otherwise(
        F.raise_error(F.format_string("%d values; the model takes %d", F.size(spectrum), F.lit(width)))
    )
    return F.lit(model.intercept) + dot(checked, model.coefficients.tolist())


def predict_all(df: DataFrame, models: Sequence[PlsModel], *, spectrum: str = "spectrum", target: str = "target", key: str = "sample_id") -> DataFrame:
    """(variant_idx, n_components, sample_id, target, prediction) of every row and model, in one pass."""
    per_model = F.array(
        *[
            F.struct(F.lit(i).alias("variant_idx"), F.lit(m.n_components).alias("n_components"), predict(F.col(spectrum), m).alias("prediction"))
            for i, m in enumerate(models)
        ]
    )
    y = F.col(target).cast("double").alias("target")
    return df.select(F.col(key).alias("sample_id"), y, F.inline(per_model)).select("variant_idx", "n_components", "sample_id", "target", "prediction")


def rmse(predictions: DataFrame) -> DataFrame:
    """(variant_idx, n_components, rmse)."""
    return predictions.groupBy("variant_idx", "n_components").agg(
        F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("target"), F.lit(2)))).alias("rmse")
    )


def select_best(variants: DataFrame) -> DataFrame:
    """The variant of least rmse; ties go to the first in sweep order."""
    best = F.min_by(F.struct("variant_idx", "n_components", "rmse"), F.struct("rmse", "variant_idx")).alias("v")
    return variants.agg(best).select("v.*")


def residuals(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residual", F.col("prediction") - F.col("target"))
