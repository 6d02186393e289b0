"""Fit/transform objects: the engine's steps as stages of ``pyspark.ml`` pipelines.

Every stage has its own reader and writer, so ``Pipeline`` and ``PipelineModel`` are
saved and loaded whole. Transforms are column expressions and work on streams;
:class:`PLSRegression` fits all component counts of a parameter grid from one pass, so a
``CrossValidator`` or ``TrainValidationSplit`` reads each fold once for the whole grid.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any
from weakref import WeakKeyDictionary

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .errors import DataError
from .functions import columns, kernels
from .functions.losses import bind_training_loss
from .functions.metrics import Metric, find_metric, metric
from .operators import pls, split
from .plans.definition import compile_plan
from .shared import Tables


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Stage(Params):
    """Defaults first, then what the caller gave."""

    def _start(self, given: dict[str, Any], **defaults: Any) -> None:
        self._setDefault(**defaults)
        self._set(**{k: v for k, v in given.items() if v is not None})


class StandardNormalVariate(_Stage, Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Each spectrum less its mean, over its deviation."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._start(self._input_kwargs, inputCol="spectrum", outputCol="spectrum")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), columns.snv(F.col(self.getInputCol())))


class SavitzkyGolay(_Stage, Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A smoothing filter or derivative; spectra may have any width, each batch of equal width is one product."""

    windowLength = _param("windowLength", "odd length of the window", TypeConverters.toInt)
    polyorder = _param("polyorder", "order of the polynomial", TypeConverters.toInt)
    deriv = _param("deriv", "order of the derivative", TypeConverters.toInt)
    mode = _param("mode", "what lies beyond the ends", TypeConverters.toString)
    cval = _param("cval", "the value beyond the ends in mode constant", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, inputCol: str | None = None, outputCol: str | None = None, windowLength: int | None = None,
        polyorder: int | None = None, deriv: int | None = None, mode: str | None = None, cval: float | None = None,
    ):
        super().__init__()
        self._start(self._input_kwargs, inputCol="spectrum", outputCol="spectrum", windowLength=11, polyorder=3, deriv=0, mode="interp", cval=0.0)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        args = tuple(self.getOrDefault(p) for p in (self.windowLength, self.polyorder, self.deriv, self.mode, self.cval))
        return dataset.withColumn(self.getOutputCol(), columns.savgol(F.col(self.getInputCol()), *args))


class KennardStoneSplit(_Stage, Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds a column ``train`` or ``test`` by a maximin split on the input spectra.

    The split of a DataFrame is kept in the shared folder as long as that object lives, so the passes of a fit, and a fitted
    or loaded pipeline that is applied to it again, find it there.
    """

    _known: WeakKeyDictionary = WeakKeyDictionary()

    testSize = _param("testSize", "share of test rows", TypeConverters.toFloat)
    idCol = _param("idCol", "unique row id", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, testSize: float | None = None, idCol: str | None = None):
        super().__init__()
        self._start(self._input_kwargs, inputCol="spectrum", outputCol="partition", testSize=0.25, idCol="sample_id")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        key, out = self.getOrDefault(self.idCol), self.getOutputCol()
        asked = (self.getOrDefault(self.testSize), key, self.getInputCol())
        known = self._known.setdefault(dataset, {})
        if asked not in known or not known[asked][0].has("split"):
            tables = Tables(dataset.sparkSession, "split")
            parts = split.kennard_stone_split(dataset, asked[0], key=key, spectrum=asked[2]).select("sample_id", "partition")
            known[asked] = (tables, tables.save(parts, "split"))
        parts = known[asked][1]
        return dataset.join(parts.select(F.col("sample_id").alias(key), F.col("partition").alias(out)), key)


class _PlsParams(_Stage, HasInputCol, HasLabelCol, HasPredictionCol):
    nComponents = _param("nComponents", "number of components", TypeConverters.toInt)
    trainCol = _param("trainCol", "column whose value 'train' marks the rows to fit on; empty: all rows", TypeConverters.toString)
    loss = _param("loss", "name of a registered training loss", TypeConverters.toString)
    lossParams = _param("lossParams", "parameters of the loss, name=value", TypeConverters.toListString)

    def _defaults(self, given: dict[str, Any]) -> None:
        self._start(
            given, inputCol="spectrum", labelCol="target", predictionCol="prediction", nComponents=2, trainCol="", loss="squared", lossParams=[]
        )


class PLSRegression(_PlsParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Partial least squares. With a loss other than ``squared``, by repeated reweighted passes."""

    @keyword_only
    def __init__(
        self, *, inputCol: str | None = None, labelCol: str | None = None, predictionCol: str | None = None, nComponents: int | None = None,
        trainCol: str | None = None, loss: str | None = None, lossParams: Sequence[str] | None = None,
    ):
        super().__init__()
        self._defaults(self._input_kwargs)

    def _train_rows(self, dataset: DataFrame) -> DataFrame:
        marked = self.getOrDefault(self.trainCol)
        rows = dataset.where(F.col(marked) == "train") if marked else dataset
        return rows.select(self.getInputCol(), self.getLabelCol())

    def _model(self, fitted: kernels.PlsModel) -> PLSRegressionModel:
        return self._copyValues(PLSRegressionModel(fitted))

    def _fit(self, dataset: DataFrame) -> PLSRegressionModel:
        rows, k = self._train_rows(dataset), self.getOrDefault(self.nComponents)
        names = {"spectrum": self.getInputCol(), "target": self.getLabelCol()}
        if self.getOrDefault(self.loss) == "squared":
            return self._model(pls.fit(rows, k, **names)[k - 1])
        params = dict(item.split("=", 1) for item in self.getOrDefault(self.lossParams))
        loss = bind_training_loss(self.getOrDefault(self.loss), **{name: float(v) for name, v in params.items()})
        return self._model(pls.fit_reweighted(rows, k, loss, **names).model)

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, PLSRegressionModel]]:
        """Grids over the component count alone cost one pass in all."""
        plain = self.getOrDefault(self.loss) == "squared" and all(set(m) <= {self.nComponents} for m in paramMaps)
        if not plain or not paramMaps:
            return super().fitMultiple(dataset, paramMaps)
        counts = [m.get(self.nComponents, self.getOrDefault(self.nComponents)) for m in paramMaps]
        models = pls.fit(self._train_rows(dataset), max(counts), spectrum=self.getInputCol(), target=self.getLabelCol())
        return iter([(i, self.copy(m)._model(models[k - 1])) for i, (m, k) in enumerate(zip(paramMaps, counts, strict=True))])


class _ModelWriter(MLWriter):
    def __init__(self, instance: PLSRegressionModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        m = self.instance.fitted
        row = [(m.n_components, m.coefficients.tolist(), m.x_mean.tolist(), m.y_mean)]
        schema = "n_components int, coefficients array<double>, x_mean array<double>, y_mean double"
        self.sparkSession.createDataFrame(row, schema).write.parquet(f"{path}/data")


class _ModelReader(MLReader):
    def load(self, path: str) -> PLSRegressionModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession, f"{PLSRegressionModel.__module__}.{PLSRegressionModel.__name__}")
        r = self.sparkSession.read.parquet(f"{path}/data").first()
        out = PLSRegressionModel(kernels.PlsModel(r.n_components, np.array(r.coefficients), np.array(r.x_mean), r.y_mean))
        out._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(out, metadata)
        return out


class PLSRegressionModel(_PlsParams, Model, MLReadable, MLWritable):
    """Adds predictions; keeps every row and column."""

    def __init__(self, fitted: kernels.PlsModel | None = None):
        super().__init__()
        self._defaults({})
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.fitted is None:
            raise DataError("the model has no coefficients")
        return dataset.withColumn(self.getPredictionCol(), pls.predict(F.col(self.getInputCol()), self.fitted))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class MetricEvaluator(_Stage, Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A registered metric as the evaluator of a parameter search."""

    metricName = _param("metricName", "name of a registered metric", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, metricName: str | None = None, labelCol: str | None = None, predictionCol: str | None = None):
        super().__init__()
        self._start(self._input_kwargs, metricName="rmse", labelCol="target", predictionCol="prediction")
        find_metric(self.getOrDefault(self.metricName))

    def _evaluate(self, dataset: DataFrame) -> float:
        return dataset.agg(metric(self.getOrDefault(self.metricName), self.getLabelCol(), self.getPredictionCol()).alias("m")).first().m

    def isLargerBetter(self) -> bool:
        found = find_metric(self.getOrDefault(self.metricName))
        return isinstance(found, Metric) and found.larger_is_better


def pipeline_of(source: Any, n_components: int | None = None) -> Pipeline:
    """The stages of a definition. A definition with a sweep has the largest count, unless one is given."""
    plan = compile_plan(source)
    stages: list = [] if plan.test_size is None else [KennardStoneSplit(testSize=plan.test_size)]
    for kind, params in plan.preprocessing:
        if kind == "StandardNormalVariate":
            stages.append(StandardNormalVariate())
        else:
            window, polyorder, deriv, mode, cval = params
            stages.append(SavitzkyGolay(windowLength=window, polyorder=polyorder, deriv=deriv, mode=mode, cval=float(cval)))
    marked = "" if plan.test_size is None else "partition"
    return Pipeline(stages=[*stages, PLSRegression(nComponents=n_components or max(plan.n_components), trainCol=marked)])
