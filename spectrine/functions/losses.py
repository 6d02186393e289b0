"""Training losses by name: what a residual costs, and how much its row weighs in a reweighted fit.

A loss rho(r) is minimised by repeated weighted least squares with weights rho'(r) / r,
normed to 1 at r = 0. Both functions take and give NumPy arrays, a batch at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from ..errors import UnsupportedCapability

Array = np.ndarray


@dataclass(frozen=True)
class Loss:
    """A loss bound to its parameters."""

    name: str
    value: Callable[[Array], Array]
    weight: Callable[[Array], Array]
    params: tuple[tuple[str, float], ...] = ()

    def __call__(self, residual) -> Array:
        return self.value(np.asarray(residual, dtype=float))


_LOSSES: dict[str, Callable[..., Loss]] = {}


def register_loss(name: str, make: Callable[..., Loss]) -> None:
    """Register ``make(**params) -> Loss`` under ``name``; a later registration replaces an earlier one."""
    _LOSSES[name] = make


def bind_training_loss(name: str, **params: float) -> Loss:
    """The loss of this name with its parameters; an unknown name or parameter is refused."""
    if name not in _LOSSES:
        raise UnsupportedCapability(f"no loss {name}; known are {', '.join(sorted(_LOSSES))}")
    try:
        return _LOSSES[name](**params)
    except TypeError as error:
        raise UnsupportedCapability(f"loss {name}: {error}") from None


def _positive(name: str, value: float) -> float:
    if not np.isfinite(value) or value <= 0:
        raise UnsupportedCapability(f"{name} must be positive")
    return float(value)


def _squared() -> Loss:
    return Loss("squared", lambda r: r * r / 2, np.ones_like)


def _huber(delta: float = 1.0) -> Loss:
    d = _positive("delta", delta)

    def value(r: Array) -> Array:
        return np.where(np.abs(r) <= d, r * r / 2, d * (np.abs(r) - d / 2))

    return Loss("huber", value, lambda r: d / np.maximum(np.abs(r), d), (("delta", d),))


def _pseudo_huber(delta: float = 1.0) -> Loss:
    d = _positive("delta", delta)
    return Loss("pseudo_huber", lambda r: d * d * (np.hypot(1, r / d) - 1), lambda r: 1 / np.hypot(1, r / d), (("delta", d),))


def _cauchy(scale: float = 1.0) -> Loss:
    c = _positive("scale", scale)
    return Loss("cauchy", lambda r: c * c / 2 * np.log1p((r / c) ** 2), lambda r: 1 / (1 + (r / c) ** 2), (("scale", c),))


for _name, _make in (("squared", _squared), ("huber", _huber), ("pseudo_huber", _pseudo_huber), ("cauchy", _cauchy)):
    register_loss(_name, _make)
