"""Bounded Arrow batches for operators whose rows are whole texts."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

BATCH_BYTES = 4 * 1024 * 1024
_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Let Python workers get at most about ``size`` bytes (or one row) at a time; a smaller setting stays.

    A batch of 10,000 rows, Spark's default, is a whole partition of documents, of
    which a worker holds several copies while it works.
    """
    number, unit = re.fullmatch(r"(-?\d+)([a-z]?)[a-z]*", spark.conf.get(_SETTING).lower()).groups()
    now = int(number) * {"k": 2**10, "m": 2**20, "g": 2**30}.get(unit, 1)
    if now <= 0 or now > size:
        spark.conf.set(_SETTING, str(size))
