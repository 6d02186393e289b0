"""Scoring streams with a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.runner import Model


def score_stream(stream: DataFrame, model: Model, *, spectrum: str = "spectrum") -> DataFrame:
    """The stream plus ``prediction``. The plan is narrow: no state, no shuffle, any output mode."""
    return model.transform(stream, spectrum=spectrum)


def write_scores(stream: DataFrame, model: Model, path: str, checkpoint: str, **trigger):
    """Start a query that appends scored rows to Parquet; by default it ends when the input is read."""
    writer = score_stream(stream, model).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)
