"""Pipeline definitions in JSON or YAML, and the plans they compile to.

Everything here runs on the driver and is finished before any data is read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from copy import deepcopy
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

from ..errors import DefinitionError
from ..functions.kernels import MODES

#: The class names of the plan language. Those of the first table stand below a root package.
BELOW_ROOT = {
    "operators.splitters.KennardStoneSplitter": "KennardStone",
    "operators.splitters.splitters.KennardStoneSplitter": "KennardStone",
    "operators.transforms.SNV": "StandardNormalVariate",
    "operators.transforms.StandardNormalVariate": "StandardNormalVariate",
    "operators.transforms.scalers.StandardNormalVariate": "StandardNormalVariate",
    "operators.transforms.SavitzkyGolay": "SavitzkyGolay",
    "operators.transforms.nirs.SavitzkyGolay": "SavitzkyGolay",
}
WHOLE = {
    "sklearn.cross_decomposition.PLSRegression": "PLSRegression",
    "sklearn.cross_decomposition._pls.PLSRegression": "PLSRegression",
}
#: Root packages that are accepted; empty: any one package. A program that wants one alone puts its name here.
ROOTS: set[str] = set()
_COMMENT = "_comment"


def operator_of(name: Any) -> str | None:
    """The operator that a class name stands for."""
    if not isinstance(name, str):
        return None
    root, _, rest = name.partition(".")
    if rest in BELOW_ROOT and (root in ROOTS if ROOTS else re.fullmatch(r"\w+", root)):
        return BELOW_ROOT[rest]
    return WHOLE.get(name)


@dataclass(frozen=True)
class Definition:
    name: str
    description: str
    random_state: int | None
    pipeline: list[Any] = field(default_factory=list)

    def as_dict(self) -> dict[str, Any]:
        """The canonical export; an absent random state is left out."""
        out = {"name": self.name, "description": self.description, "pipeline": deepcopy(self.pipeline)}
        return out if self.random_state is None else out | {"random_state": self.random_state}


@dataclass(frozen=True)
class Plan:
    """What is executed: an optional splitter, row-wise transforms in order, component counts in sweep order."""

    test_size: float | None
    preprocessing: tuple[tuple[str, tuple], ...]
    n_components: tuple[int, ...]


def _path_of(text: str) -> Path | None:
    """A string without line breaks that ends in .json, .yaml or .yml, or names a file, is a path."""
    if "\n" in text:
        return None
    if re.search(r"\.(json|ya?ml)$", text.strip(), re.I):
        return Path(text)
    try:
        return Path(text) if text.strip() and Path(text).exists() else None
    except OSError:
        return None


def _parse(text: str, suffix: str = "") -> Any:
    if suffix != ".json" and suffix in (".yaml", ".yml"):
        return _yaml(text)
    try:
        return json.loads(text)
    except json.JSONDecodeError as error:
        if suffix == ".json":
            raise DefinitionError(f"not JSON: {error}") from error
        return _yaml(text)


def _yaml(text: str) -> Any:
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as error:
        raise DefinitionError(f"neither JSON nor YAML: {error}") from error


def _without_comments(node: Any) -> Any:
    if isinstance(node, dict):
        return {k: _without_comments(v) for k, v in node.items() if k != _COMMENT}
    if isinstance(node, list):
        return [_without_comments(x) for x in node if not (isinstance(x, dict) and set(x) == {_COMMENT})]
    return node


def class_names(source: Any) -> list[str]:
    """Every string under a key ``class``, at any depth, in document order, repeats kept."""
    node = load(source).pipeline if isinstance(source, (str, Path)) else source.pipeline if isinstance(source, Definition) else source
    if isinstance(node, dict):
        own = [node["class"]] if isinstance(node.get("class"), str) else []
        return own + [n for v in node.values() if isinstance(v, (dict, list)) for n in class_names(v)]
    if isinstance(node, list):
        return [n for x in node if isinstance(x, (dict, list)) for n in class_names(x)]
    return []


def load(source: str | Path | dict | list | Definition) -> Definition:
    """Read, normalise and validate a definition from a path, a text, a mapping or a list of steps."""
    if isinstance(source, Definition):
        return source
    if isinstance(source, (dict, list)):
        tree = deepcopy(source)
    else:
        path = source if isinstance(source, Path) else _path_of(source)
        tree = _parse(path.read_text("utf-8"), path.suffix.lower()) if path else _parse(source)
    if isinstance(tree, list):
        tree = {"pipeline": tree}
    if not isinstance(tree, dict):
        raise DefinitionError("a definition is a list of steps or a mapping that holds one")
    key = next((k for k in ("pipeline", "steps") if k in tree), None)
    if key is None or not isinstance(tree[key], list):
        raise DefinitionError("'pipeline' or 'steps' must hold a list of steps")
    steps = _without_comments(tree[key])
    unknown = dict.fromkeys(n for n in class_names(steps) if operator_of(n) is None)
    if unknown:
        raise DefinitionError("classes outside the supported set: " + ", ".join(unknown))
    state = tree.get("random_state")
    if isinstance(state, bool):
        state = None
    if state is not None and not isinstance(state, int):
        raise DefinitionError("'random_state' must be an integer")
    return Definition(str(tree.get("name") or "pipeline"), str(tree.get("description") or ""), state, steps)


def number(value: Any, what: str) -> float:
    """A finite number from a number or numeric string."""
    if isinstance(value, bool) or not isinstance(value, (int, float, str)):
        raise DefinitionError(f"{what} must be a number, not {value!r}")
    try:
        got = float(value)
    except ValueError:
        raise DefinitionError(f"{what} must be a number, not {value!r}") from None
    if not math.isfinite(got):
        raise DefinitionError(f"{what} must be finite")
    return got


def integer(value: Any, what: str) -> int:
    """A whole number of 32 bits; nothing is truncated."""
    got = number(value, what)
    if got != int(got) or not -(2**31) <= got < 2**31:
        raise DefinitionError(f"{what} must be a whole number, not {value!r}")
    return int(got)


def _given(params: dict, *names: str, default: Any) -> Any:
    return next((params[n] for n in names if params.get(n) is not None), default)


def savgol_params(params: dict) -> tuple[int, int, int, str, float]:
    """(window_length, polyorder, deriv, mode, cval); null counts as absent."""
    if number(_given(params, "delta", default=1.0), "delta") != 1.0:
        raise DefinitionError("only delta = 1 is supported")
    mode = _given(params, "mode", default="interp")
    if isinstance(mode, str) and mode.lower() in MODES:
        mode = mode.lower()
    else:
        try:
            code = integer(mode, "mode")
        except DefinitionError:
            code = -1
        if not 0 <= code < len(MODES):
            raise DefinitionError(f"unknown mode {mode!r}")
        mode = MODES[code]
    window = integer(_given(params, "window_length", "window", default=11), "window_length")
    polyorder = integer(_given(params, "polyorder", default=3), "polyorder")
    deriv = integer(_given(params, "deriv", default=0), "deriv")
    if window < 1 or window % 2 == 0 or not 0 <= polyorder < window or deriv < 0:
        raise DefinitionError("need an odd window_length above polyorder >= 0, and deriv >= 0")
    return window, polyorder, deriv, mode, number(_given(params, "cval", default=0.0), "cval")


def component_counts(step: dict) -> tuple[int, ...]:
    """The sweep of a model step: an inclusive range, or one count (default 2)."""
    if step.get("_range_") is not None:
        if step.get("param") != "n_components":
            raise DefinitionError("a _range_ sweeps 'n_components' only")
        bounds = step["_range_"]
        if not isinstance(bounds, list) or len(bounds) != 3:
            raise DefinitionError("_range_ is [start, stop, step]")
        start, stop, stride = (integer(v, "_range_") for v in bounds)
        if stride < 1 or start < 1 or start > stop:
            raise DefinitionError("_range_ needs 1 <= start <= stop and a positive step")
        return tuple(range(start, stop + 1, stride))
    params = step["model"].get("params") or {}
    count = integer(_given(params, "n_components", default=2), "n_components")
    if count < 1:
        raise DefinitionError("n_components must be positive")
    return (count,)


def _test_size(params: dict) -> float:
    size = number(_given(params, "test_size", default=0.25), "test_size")
    if not 0 < size < 1:
        raise DefinitionError("test_size must lie between 0 and 1")
    return size


#: What a step of each operator adds to a plan: its role, and its value from the step's parameters.
_STEPS: dict[str, tuple[str, Callable[[dict], Any]]] = {
    "KennardStone": ("splitter", _test_size),
    "StandardNormalVariate": ("transform", lambda params: ("StandardNormalVariate", ())),
    "SavitzkyGolay": ("transform", lambda params: ("SavitzkyGolay", savgol_params(params))),
}


def _part(step: Any) -> tuple[str, Any]:
    """(role, value) of a step."""
    if not isinstance(step, dict):
        raise DefinitionError("a step is a mapping")
    name, params = step.get("class"), step.get("params") or {}
    if isinstance(name, str):
        if not isinstance(params, dict):
            raise DefinitionError("params must be a mapping")
        if operator_of(name) not in _STEPS:
            raise DefinitionError(f"class {name!r} is no step")
        role, value = _STEPS[operator_of(name)]
        return role, value(params)
    model = step.get("model")
    if not isinstance(model, dict):
        raise DefinitionError(f"not a step: {step!r}")
    if operator_of(model.get("class")) != "PLSRegression":
        raise DefinitionError(f"class {model.get('class')!r} is no model")
    return "model", component_counts(step)


def compile_plan(source: Any) -> Plan:
    """The plan of a definition. The last splitter counts; there is exactly one model, a PLS regression."""
    parts = [_part(step) for step in load(source).pipeline]
    sizes, transforms, models = ([v for r, v in parts if r == role] for role in ("splitter", "transform", "model"))
    if len(models) != 1:
        raise DefinitionError("a pipeline has one model" if models else "a pipeline needs a model")
    return Plan(sizes[-1] if sizes else None, tuple(transforms), models[0])


def parity(a: Any, b: Any) -> dict[str, bool]:
    """Whether two definitions agree in classes, random state, name and plan."""
    a, b = load(a), load(b)
    return {
        "classes": class_names(a) == class_names(b), "random_state": a.random_state == b.random_state,
        "name": a.name == b.name, "plan": compile_plan(a) == compile_plan(b),
    }
