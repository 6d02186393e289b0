"""Stable hashes: SHA-256 of canonical JSON (sorted keys, no blanks, no NaN), of values and of columns."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def stable_hash(value: Any) -> str:
    """SHA-256 of compact JSON with sorted keys."""
    return hashlib.sha256(canonical(value).encode()).hexdigest()


def _plain(kind: pa.DataType) -> Callable[[Any], Any] | None:
    """What turns a value of this Arrow type into what JSON knows; None if it already is. Other types are refused."""
    if pa.types.is_map(kind):
        if not pa.types.is_string(kind.key_type):
            raise TypeError(f"a map with keys of type {kind.key_type} has no JSON form")
        inner = _plain(kind.item_type) or (lambda v: v)
        return lambda v: None if v is None else {k: inner(x) for k, x in v}
    if pa.types.is_struct(kind):
        inner = {f.name: _plain(f.type) for f in kind}
        if not any(inner.values()):
            return None
        return lambda v: None if v is None else {k: f(v[k]) if (f := inner[k]) else v[k] for k in v}
    if pa.types.is_list(kind):
        each = _plain(kind.value_type)
        return each and (lambda v: None if v is None else [each(x) for x in v])
    if pa.types.is_boolean(kind) or pa.types.is_integer(kind) or pa.types.is_floating(kind) or pa.types.is_string(kind) or pa.types.is_null(kind):
        return None
    raise TypeError(f"{kind} has no JSON form")


def stable_hash_of(value: Column) -> Column:
    """:func:`stable_hash` of each row's value, of any nesting of structs, arrays, maps with text keys, text, numbers and booleans."""

    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        change = _plain(values.type)
        return pa.array([stable_hash(change(v) if change else v) for v in values.to_pylist()], pa.string())

    return run(value)
