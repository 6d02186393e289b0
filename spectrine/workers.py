"""Makes this package importable in Python workers that share the driver's file system."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def ready(spark: SparkSession) -> None:
    """Put the package's folder on the workers' PYTHONPATH.

    On a cluster without a shared file system install the package on the
    executors or pass it with ``--py-files``; this setting then does nothing.
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))
