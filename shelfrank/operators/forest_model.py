"""The histogram forest as a pipeline stage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import functions as F

from shelfrank.operators.forest import FOREST_DEFAULTS, MAX_BINS, Forest, fit_forest, leaf_values, tree_groups


def _sum_of(shared, edges: list[np.ndarray]):
    """A function of arrays of features: the sum over some trees."""

    def added(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.stack(batch) if len(batch) else np.empty((0, len(edges)))
            bins = np.stack([np.searchsorted(e, x) for e, x in zip(edges, rows.T, strict=True)], axis=1).astype(np.uint16)
            yield pd.Series(sum((leaf_values(tree, bins) for tree in shared.value), np.zeros(len(batch))))

    return F.pandas_udf(added, "double")


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """The mean prediction of all trees for vectors of features."""

    def __init__(self, forest: Forest | None = None):
        super().__init__()
        self.forest = forest
        self._importances: DenseVector | None = None

    @property
    def featureImportances(self) -> DenseVector:
        if self._importances is None:
            shares = {r["feature"]: r["importance"] for r in self.forest.importances().collect()}
            self._importances = Vectors.dense([shares[c] for c in self.forest.edges])
        return self._importances

    def _transform(self, dataset):
        edges = [np.asarray(e, float) for e in self.forest.edges.values()]
        total = F.lit(0.0)
        for trees in tree_groups(self.forest.nodes):
            shared = dataset.sparkSession.sparkContext.broadcast(trees)
            total = total + _sum_of(shared, edges)(vector_to_array(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), total / self.forest.trees)

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.forest.save(f"{path}/forest")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = ForestModel(Forest.load(self.sparkSession, f"{path}/forest"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class ForestRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    """``fit_forest`` over a column of vectors.

    Which rows a tree draws follows the column ``keyCol``, or the row's own features and label where the table has no such column.
    """

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    minRowsToSplit = Param(Params._dummy(), "minRowsToSplit", "nodes of fewer rows are not split", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows that a split leaves on each side at least", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "values or quantiles of a column that can cut it", TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "column that names a row", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", predictionCol="prediction", seed=42, numTrees=FOREST_DEFAULTS["trees"], maxDepth=FOREST_DEFAULTS["depth"],
        minRowsToSplit=FOREST_DEFAULTS["min_split"], minInstancesPerNode=FOREST_DEFAULTS["min_leaf"], maxBins=MAX_BINS, keyCol="item_id",
    ):
        super().__init__()
        self._setDefault(
            seed=42, numTrees=FOREST_DEFAULTS["trees"], maxDepth=FOREST_DEFAULTS["depth"], minRowsToSplit=FOREST_DEFAULTS["min_split"],
            minInstancesPerNode=FOREST_DEFAULTS["min_leaf"], maxBins=MAX_BINS, keyCol="item_id",
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        name, features, label = self.getOrDefault(self.keyCol), F.col(self.getFeaturesCol()), F.col(self.getLabelCol()).cast("double")
        first = dataset.select(features).first()
        if first is None:
            raise ValueError("there are no rows to fit")
        values = vector_to_array(features)
        key = F.col(name) if name in dataset.columns else F.xxhash64(values, label)
        columns = [f"x{i}" for i in range(first[0].size)]
        rows = dataset.select(key.alias("key"), label.alias("label"), values.alias("values"))
        matrix = rows.select("key", "label", *[F.col("values")[i].alias(c) for i, c in enumerate(columns)])
        forest = fit_forest(
            matrix, columns, key="key", trees=self.getOrDefault(self.numTrees), depth=self.getOrDefault(self.maxDepth), min_split=self.getOrDefault(self.minRowsToSplit),
            min_leaf=self.getOrDefault(self.minInstancesPerNode), max_bins=self.getOrDefault(self.maxBins), seed=self.getSeed(),
        )
        model = ForestModel(forest)
        return model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
