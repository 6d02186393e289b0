"""Numeric kernels in NumPy: small matrices on the driver, one group in a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, factorial

import numpy as np

from ..errors import DataError, DefinitionError

#: Savitzky-Golay boundary modes by code. Fixed values.
MODES = ("mirror", "constant", "nearest", "wrap", "interp")


def savgol_matrix(
    width: int, window: int = 11, polyorder: int = 3, deriv: int = 0, mode: str = "interp", cval: float = 0.0
) -> tuple[np.ndarray, np.ndarray]:
    """(O, c) such that the filtered row is O x + c, for rows of ``width`` values (delta = 1)."""
    if window < 1 or window % 2 == 0:
        raise DefinitionError(f"window_length must be odd and positive, not {window}")
    if not 0 <= polyorder < window:
        raise DefinitionError(f"polyorder {polyorder} must be below window_length {window}")
    if deriv < 0:
        raise DefinitionError("deriv must not be negative")
    if mode not in MODES:
        raise DefinitionError(f"unknown mode {mode!r}")
    half = window // 2
    fit = np.linalg.pinv(np.vander(np.arange(-half, half + 1.0), polyorder + 1, increasing=True))

    def weights(at: float) -> np.ndarray:
        """Weights of a window's samples for the derivative of its polynomial at offset ``at``."""
        powers = np.zeros(polyorder + 1)
        for k in range(deriv, polyorder + 1):
            powers[k] = factorial(k) / factorial(k - deriv) * at ** (k - deriv)
        return powers @ fit

    centre = weights(0.0)
    matrix, offset = np.zeros((width, width)), np.zeros(width)
    if mode == "interp" and window > width:
        raise DefinitionError(f"mode interp needs rows of at least {window} values, not {width}")
    for row in range(width):
        if mode == "interp" and (row < half or row >= width - half):
            middle = half if row < half else width - 1 - half
            matrix[row, middle - half : middle + half + 1] = weights(row - middle)
            continue
        for weight, col in zip(centre, range(row - half, row + half + 1), strict=True):
            if 0 <= col < width:
                matrix[row, col] += weight
            elif mode == "constant":
                offset[row] += weight * cval
            elif mode == "nearest":
                matrix[row, min(max(col, 0), width - 1)] += weight
            elif mode == "wrap":
                matrix[row, col % width] += weight
            else:
                period = max(1, 2 * (width - 1))
                col = abs(col) % period
                matrix[row, min(col, period - col)] += weight
    return matrix, offset


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, by differences, so that large offsets do not cancel."""
    return ((x - y) ** 2).sum(-1)


#: Values of an intermediate matrix, and of the pairs whose distances are taken by differences at once.
_CELLS, _PAIRS = 1_000_000, 2_000_000
#: Rows of one side that a product takes, so that it stays in the caches.
_TILE = 2048


class Screen:
    """Squared distances to the rows of ``y`` as one product in single precision, and how far they may be off.

    Rows are moved to ``centre`` and scaled by ``scale``, so that single precision holds them; so are the distances.
    """

    def __init__(self, y: np.ndarray, centre: np.ndarray, kind: type = np.float32):
        moved = y - centre
        self.y, self.centre, self.kind = y, centre, kind
        self.norms = np.einsum("ij,ij->i", moved, moved)
        self.most = float(self.norms.max(initial=0.0))
        self.scale = 1.0 / self.most if 1e-290 < self.most < np.inf else 1.0
        self.factor = np.empty((y.shape[1] + 1, len(y)), kind)
        self.factor[:-1] = (-2 * np.sqrt(self.scale)) * moved.T
        self.factor[-1] = self.norms * self.scale

    def rows(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``times`` takes, the scaled squared norms, and by how much a distance of each row may be off."""
        moved = (x - self.centre) * np.sqrt(self.scale)
        norms = np.einsum("ij,ij->i", moved, moved)
        slack = (x.shape[1] + 8) * 2 * float(np.finfo(self.kind).eps) * (norms + self.most * self.scale) + 1e-30
        if self.kind is np.float32 and norms.max(initial=0.0) > 1e30:  # beyond single precision: nothing is told from anything
            moved, slack = np.where(norms[:, None] > 1e30, 0.0, moved), np.where(norms > 1e30, np.inf, slack)
        out = np.ones((len(x), x.shape[1] + 1), self.kind)
        out[:, :-1] = moved
        return out, norms, slack

    def times(self, rows: np.ndarray) -> np.ndarray:
        """Scaled squared distances less the squared norm of each row."""
        return rows @ self.factor


def _exact(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, squared distance) of pairs of rows, by parts."""
    step = max(1, _PAIRS // max(1, x.shape[1]))
    for c in range(0, len(i), step):
        yield i[c : c + step], j[c : c + step], squares(x[i[c : c + step]], y[j[c : c + step]])


def farthest(x: np.ndarray, names: np.ndarray, y: np.ndarray, others: np.ndarray, centre: np.ndarray, least: float = -1.0) -> tuple[float, int, int] | None:
    """(squared distance, smaller name, larger name) of the farthest pair of a row of ``x`` and one of ``y``.

    Of equal pairs the one with the smallest names; rows of one name are no pair. None if all pairs are nearer
    than ``least``. Products choose, differences decide.
    """
    best: tuple[float, int, int] | None = None
    for c in range(0, len(y), _TILE):
        found = _farthest_of(x, names, y[c : c + _TILE], others[c : c + _TILE], centre, least if best is None else best[0]) if len(x) else None
        if found and (best is None or (-found[0], *found[1:]) < (-best[0], *best[1:])):
            best = found
    return best


def _farthest_of(x: np.ndarray, names: np.ndarray, y: np.ndarray, others: np.ndarray, centre: np.ndarray, least: float) -> tuple[float, int, int] | None:
    """:func:`farthest` for as many rows of ``y`` as a product takes."""
    best: tuple[float, int, int] | None = None
    coarse, fine = Screen(y, centre), None
    for k in range(0, len(x), step := max(1, _CELLS // len(y))):
        part, held = x[k : k + step], coarse
        for _ in range(2):
            rows, norms, slack = held.rows(part)
            far = held.times(rows)
            known = (least if best is None else best[0]) * held.scale
            top = norms + far.max(1)
            bound = max(known, float((top - slack).max()))
            some = np.nonzero(~(top + slack < bound))[0]
            i, j = np.nonzero(~(far[some] < (bound - norms - slack)[some, None]))
            i = some[i]
            if held is not coarse or len(i) <= 16 * len(part):
                break
            fine = held = fine or Screen(y, centre, np.float64)
        keep = names[i + k] != others[j]
        for i, j, d in _exact(part, y, i[keep], j[keep]):
            most = d.max()
            if most >= least and (best is None or most >= best[0]):
                tied = d == most
                a, b = names[i[tied] + k], others[j[tied]]
                low, high = np.minimum(a, b), np.maximum(a, b)
                at = np.lexsort((high, low))[0]
                found = (float(most), low[at].item(), high[at].item())
                if best is None or (-found[0], *found[1:]) < (-best[0], *best[1:]):
                    best = found
    return best


def nearest_squares(x: np.ndarray, chosen: np.ndarray, nearest: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The smaller of ``nearest`` and each row's squared distance to the nearest row of ``chosen``."""
    out = nearest.copy()
    for c in range(0, len(chosen), _TILE):
        _lower(out, x, chosen[c : c + _TILE], centre)
    return out


def _lower(out: np.ndarray, x: np.ndarray, chosen: np.ndarray, centre: np.ndarray) -> None:
    """:func:`nearest_squares` in place, for as many rows of ``chosen`` as a product takes."""
    coarse, fine = Screen(chosen, centre), None
    for k in range(0, len(x), step := max(1, _CELLS // len(chosen))):
        part, now = x[k : k + step], out[k : k + step]
        some, held = np.arange(len(part)), coarse
        for _ in range(2):
            rows, norms, slack = held.rows(part[some])
            near = held.times(rows)
            low = near.min(1)
            limit = np.minimum(low + 2 * slack, now[some] * held.scale - norms + slack)
            less = np.nonzero(~(low > limit))[0]
            i, j = np.nonzero(~(near[less] > limit[less, None]))
            i = some[less[i]]
            if held is not coarse or len(i) <= 16 * len(part):
                break
            some, held = some[less], fine or Screen(chosen, centre, np.float64)
            fine = held
        for i, j, d in _exact(part, chosen, i, j):
            np.minimum.at(now, i, d)


def choose(x: np.ndarray, nearest: np.ndarray, most: int, beaten: Callable[[float, int], bool] | None = None, *, tabled: int = 4096) -> np.ndarray:
    """Row numbers chosen one after another: always the row farthest from those chosen, of equal ones the first.

    ``nearest`` holds each row's squared distance to those chosen before, -1 for these. It ends after ``most``
    choices, or when ``beaten(distance, row)`` says that a row which is not here is better. Up to ``tabled`` rows all
    products are made at once.
    """
    nearest, chosen = nearest.copy(), []
    screen = Screen(x, x.mean(0))
    rows, norms, slack = screen.rows(x)
    table = screen.times(rows) if len(x) <= tabled else None
    # a row's distance may be lowered where the product lies below this
    limit = nearest * screen.scale + slack
    for _ in range(min(most, int((nearest >= 0).sum()))):
        at = int(np.argmax(nearest))
        if beaten is not None and beaten(float(nearest[at]), at):
            break
        chosen.append(at)
        near = table[at] if table is not None else rows[at] @ screen.factor
        lower = np.nonzero(near < limit - norms[at] + slack[at])[0]
        if len(lower):
            nearest[lower] = np.minimum(nearest[lower], squares(x[lower], x[at]))
            limit[lower] = nearest[lower] * screen.scale + slack[lower]
        nearest[at] = limit[at] = -1.0
    return np.array(chosen, dtype=np.int64)


def kennard_stone(x: np.ndarray, n_train: int) -> np.ndarray:
    """Row numbers in order of selection: the farthest pair, then always the row farthest from those chosen.

    Ties go to the smaller row number. Memory is linear in the rows.
    """
    n = len(x)
    n_train = min(n_train, n)
    if n_train <= 0:
        return np.zeros(0, dtype=np.int64)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    x, centre, names = np.asarray(x, float), x.mean(0), np.arange(n)
    best: tuple[float, int, int] | None = None
    for a in range(0, n, 4096):  # a block meets itself and what follows it
        found = farthest(x[a:], names[a:], x[a : a + 4096], names[a : a + 4096], centre, -1.0 if best is None else best[0])
        if found and (best is None or (-found[0], *found[1:]) < (-best[0], *best[1:])):
            best = found
    first = list(best[1:])[:n_train]
    nearest = np.min([squares(x, x[i]) for i in first], axis=0)
    nearest[first] = -1.0
    return np.r_[np.array(first, dtype=np.int64), choose(x, nearest, n_train - len(first))]


def test_rows(n: int, test_size: float) -> int:
    """ceil(n * test_size), at least one row left on either side."""
    if not 0 < test_size < 1:
        raise DefinitionError("test_size must lie between 0 and 1")
    if n < 2:
        raise DataError("a split needs two rows")
    return min(n - 1, max(1, ceil(n * test_size - 1e-12)))


@dataclass(frozen=True)
class PlsModel:
    """An affine model: prediction = intercept + coefficients . x."""

    n_components: int
    coefficients: np.ndarray
    x_mean: np.ndarray
    y_mean: float

    @property
    def intercept(self) -> float:
        return float(self.y_mean - self.x_mean @ self.coefficients)


def pls_from_moments(n: float, sx, sy: float, sxx, sxy, syy: float, k_max: int) -> list[PlsModel]:
    """PLS1 models with 1..k_max components from sums over rows (scaled, centred; kernel recurrence).

    Columns and targets without spread are left unscaled. When nothing of the target
    remains to be explained, the last model is repeated.
    """
    sx, sxx, sxy = np.asarray(sx, float), np.asarray(sxx, float), np.asarray(sxy, float)
    x_mean, y_mean, x_std, y_std = centres(n, sx, sy, np.diag(sxx), syy, k_max)
    cov = sxx - n * np.outer(x_mean, x_mean)
    c, s = cov / np.outer(x_std, x_std), (sxy - n * x_mean * y_mean) / (x_std * y_std)
    return [PlsModel(k, y_std * beta / x_std, x_mean, float(y_mean)) for k, beta in enumerate(pls_slopes(s, lambda r: c @ r, k_max), 1)]


def centres(n: float, sx: np.ndarray, sy: float, squares: np.ndarray, syy: float, k_max: int) -> tuple[np.ndarray, float, np.ndarray, float]:
    """Means and population deviations of columns and target from their sums; 1 where there is no spread."""
    if k_max < 1 or k_max > min(n - 1, len(sx)):
        raise DataError(f"n_components {k_max} must lie between 1 and {int(min(n - 1, len(sx)))}")
    x_mean, y_mean = sx / n, sy / n
    x_std = np.sqrt(np.maximum(squares - n * x_mean**2, 0) / n)
    y_std = np.sqrt(max(syy - n * y_mean**2, 0) / n)
    x_std[x_std <= 1e-12 * np.maximum(1.0, np.abs(x_mean))] = 1.0
    return x_mean, y_mean, x_std, y_std if y_std > 1e-12 * max(1.0, abs(y_mean)) else 1.0


def pls_slopes(s: np.ndarray, times: Callable[[np.ndarray], np.ndarray], k_max: int) -> Iterator[np.ndarray]:
    """Slopes of the models with 1..k_max components in scaled columns.

    ``s`` is the covariance of the columns with the target; ``times(r)`` is the columns'
    covariance matrix times r, which nothing else needs: it may come from a stored matrix or
    from a pass over the rows.
    """
    s, start = s.copy(), np.linalg.norm(s)
    rotations, loadings = [], []
    beta = np.zeros(len(s))
    for _ in range(k_max):
        size = np.linalg.norm(s)
        if size > 1e-12 * max(1.0, start):
            r = s / size
            for p, before in zip(loadings, rotations, strict=True):
                r = r - (p @ (s / size)) * before
            cr = times(r)
            tau = r @ cr
            if tau > 0:
                p, q = cr / tau, (r @ s) / tau
                s = s - p * q * tau
                rotations.append(r)
                loadings.append(p)
                beta = beta + r * q
        yield beta
