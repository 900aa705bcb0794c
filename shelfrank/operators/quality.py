"""Regression models of item quality: training, evaluation, tuning, prediction."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce
from math import ceil
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions.numbers import clip, hash60
from shelfrank.operators.features import FeatureState, feature_matrix
from shelfrank.operators.fold_stats import LINEAR_KINDS, fold_fits, part_triangles, share_of
from shelfrank.operators.quantiles import threshold_for_smallest

SEED = 42
MERGING_TASKS = 8
# The settings and grids of the models.
FOREST = {"numTrees": 100, "maxDepth": 15}
RIDGE_ALPHAS = (0.1, 1.0, 10.0, 100.0, 1000.0)
FOREST_GRID = {"numTrees": (100, 200, 300), "maxDepth": (10, 20, 30), "minInstancesPerNode": (1, 2, 4)}
TOLERANCES = (5, 10)
METRICS = ("rmse", "mae", "r2")
FIT_COLUMNS = ("model", "share", "fold", "set", "rows", "r2", "rmse")


class LeastSquaresModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Weights and intercept of a linear model."""

    weights = Param(Params._dummy(), "weights", "one weight for each feature", TypeConverters.toListFloat)
    bias = Param(Params._dummy(), "bias", "the intercept", TypeConverters.toFloat)

    @property
    def coefficients(self) -> DenseVector:
        return Vectors.dense(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.bias)

    def _transform(self, dataset):
        parts = F.zip_with(
            vector_to_array(self.getFeaturesCol()), F.array(*[F.lit(w) for w in self.getOrDefault(self.weights)]), lambda x, w: x * w
        )
        return dataset.withColumn(self.getPredictionCol(), F.aggregate(parts, F.lit(self.intercept), lambda total, part: total + part))


class RidgeRegression(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Least squares with ``alpha`` times the squared weights, intercept unpenalised; the shortest solution where there are many.

    One pass reduces the rows to a small triangle (a QR decomposition of blocks, merged in two steps), which keeps nearly dependent
    columns apart as sums of products would not; the small system that is left is solved exactly.
    """

    alpha = Param(Params._dummy(), "alpha", "penalty on the sum of squared weights", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", alpha=1.0):
        super().__init__()
        self._setDefault(alpha=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        triangle = _triangle(dataset, self.getFeaturesCol(), self.getLabelCol())
        if triangle is None:
            raise ValueError("there are no rows to fit")
        # The first column is all ones: what stands below its row is the triangle of the centred columns.
        rows = triangle[0, 0] ** 2
        means = triangle[0, 1:] / triangle[0, 0]
        weights = _solve(triangle[1:, 1:-1], triangle[1:, -1], self.getOrDefault(self.alpha), rows)
        model = LeastSquaresModel()
        model._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model._set(weights=[float(w) for w in weights], bias=float(means[-1] - means[:-1] @ weights))


def _triangle(dataset: DataFrame, features: str, label: str) -> np.ndarray | None:
    """The triangle R of the QR decomposition of (1, features, label) over all rows; None without rows."""

    def partial(batches):
        triangle = None
        for batch in batches:
            if len(batch):
                rows = np.column_stack([np.ones(len(batch)), np.stack(batch["x"]), batch["y"]])
                triangle = np.linalg.qr(rows if triangle is None else np.vstack([triangle, rows]), mode="r")
        if triangle is not None:
            yield pd.DataFrame({"row": list(triangle)})

    def merged(batches):
        rows = [np.stack(batch["row"]) for batch in batches if len(batch)]
        if rows:
            yield pd.DataFrame({"row": list(np.linalg.qr(np.vstack(rows), mode="r"))})

    rows = dataset.where(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    parts = rows.mapInPandas(partial, "row array<double>").repartition(MERGING_TASKS).mapInPandas(merged, "row array<double>")
    found = parts.toPandas()["row"]
    if not len(found):
        return None
    stacked = np.stack(found)
    missing = max(0, stacked.shape[1] - len(stacked))
    return np.linalg.qr(np.vstack([stacked, np.zeros((missing, stacked.shape[1]))]), mode="r")


def _solve(triangle: np.ndarray, right: np.ndarray, alpha: float, rows: float) -> np.ndarray:
    """Penalised weights; without a penalty, the shortest ones, with no part in directions that the columns do not span."""
    columns = triangle.shape[1]
    if alpha > 0:
        triangle = np.vstack([triangle, alpha**0.5 * np.eye(columns)])
        right = np.concatenate([right, np.zeros(columns)])
    return np.linalg.lstsq(triangle, right, rcond=np.finfo(float).eps * max(rows, columns))[0]


def make_regressor(kind: str, **settings) -> Estimator:
    """``linear``, ``ridge`` or ``random_forest``."""
    if kind == "linear":
        return RidgeRegression(alpha=0.0, **settings)
    if kind == "ridge":
        return RidgeRegression(**{"alpha": 1.0, **settings})
    if kind == "random_forest":
        from shelfrank.operators.forest_model import ForestRegressor  # it needs the splits and metrics below

        return ForestRegressor(**{**FOREST, "seed": SEED, **settings})
    raise ValueError(f"unknown model type: {kind}")


def is_forest(model) -> bool:
    return hasattr(model, "featureImportances")


# Splits and scaling


def split_sizes(rows: int, fractions: Sequence[float]) -> list[int]:
    """Rows per held-out part; every part but the first (training) rounds up."""
    held = [ceil(round(rows * f, 9)) for f in fractions[1:]]
    return [rows - sum(held), *held]


def split_sets(
    df: DataFrame,
    fractions: Mapping[str, float] | None = None,
    seed: int = SEED,
    key: str = "item_id",
) -> DataFrame:
    """Add ``set``: repeatable parts of exact size, by the order of hashed keys.

    The hash values that separate the parts are found by rank selection, so no task sorts the table.
    """
    fractions = dict(fractions or {"train": 0.7, "val": 0.15, "test": 0.15})
    hashed = df.withColumn("_h", hash60(key, F.lit(seed)))
    total = df.count()
    sizes = split_sizes(total, list(fractions.values()))
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes) - 1)]
    cuts = threshold_for_smallest(hashed, "_h", ends, total)
    names = list(fractions)
    label = F.lit(names[-1])
    for name, cut in reversed(list(zip(names, cuts))):
        label = F.lit(name) if cut is None else F.when(F.col("_h") < cut, name).otherwise(label)
    return hashed.withColumn("set", label).drop("_h")


def fold_of(key: str, folds: int, seed: int = SEED) -> Column:
    return F.pmod(hash60(key, F.lit(seed)), F.lit(folds)).cast("int")


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Zero mean, unit population standard deviation; a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    row = source.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return df.withColumns(
        {c: (F.col(c).cast("double") - row[f"m{i}"]) / (row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}
    )


def scaling_stages(columns: Sequence[str], rows: int) -> list:
    """Assemble and scale; Spark divides by the sample deviation, the last stage turns that into the population one."""
    correction = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(columns), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            inputCol="_scaled", outputCol="features", scalingVec=Vectors.dense([correction] * len(columns))
        ),
    ]


class FeatureScaler:
    """Fit once, transform later; transforming first is an error."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.model: PipelineModel | None = None

    def fit(self, df: DataFrame) -> "FeatureScaler":
        self.model = Pipeline(stages=scaling_stages(self.columns, df.count())).fit(df)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("scaler is not fitted")
        return self.model.transform(df).drop("_raw", "_scaled")


# Metrics


def metrics_by_set(
    predicted: DataFrame, label: str = "label", prediction: str = "prediction", group: Sequence[str] = ("set",)
) -> DataFrame:
    """RMSE, MAE and R² of every group in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    scored = predicted.where(y.isNotNull() & p.isNotNull())
    return scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
    )


def within_tolerance(
    predicted: DataFrame,
    tolerances: Sequence[float] = TOLERANCES,
    label: str = "label",
    prediction: str = "prediction",
    group: Sequence[str] = ("set",),
) -> DataFrame:
    """Percentage of rows whose prediction is off by at most each tolerance."""
    error = F.abs(F.col(label) - F.col(prediction))
    shares = [(F.avg((error <= t).cast("double")) * 100).alias(f"within_{t}") for t in tolerances]
    return predicted.groupBy(*group).agg(*shares)


def residuals(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predicted.withColumn("residual", F.col(label) - F.col(prediction))


# Training


@dataclass
class QualityModel:
    """A fitted scaling-and-regression pipeline with what is needed to use it later."""

    kind: str
    pipeline: PipelineModel
    state: FeatureState
    metrics: dict[str, float] = field(default_factory=dict)
    best_params: dict[str, float] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.pipeline.stages[0].getInputCols()

    def predict(self, matrix: DataFrame, clipped: bool = True, output: str = "prediction") -> DataFrame:
        """Predictions for a feature matrix, limited to 0..100 unless ``clipped`` is off."""
        predicted = self.pipeline.transform(matrix).drop("_raw", "_scaled", "features")
        value = clip(F.col("prediction")) if clipped else F.col("prediction")
        return predicted.withColumn("prediction", value).withColumnRenamed("prediction", output)

    def score_items(self, items: DataFrame, output: str = "quality_score_pred") -> DataFrame:
        """Quality of catalog items: ``item_id`` and the prediction."""
        return self.predict(feature_matrix(items, self.state, target=None), output=output).select("item_id", output)

    def importances(self, top_n: int = 20) -> DataFrame | None:
        """Most important features of a forest; None for other models."""
        model = self.pipeline.stages[-1]
        if not is_forest(model):
            return None
        pairs = list(zip(self.columns, (float(x) for x in model.featureImportances)))
        frame = SparkSession.active().createDataFrame(pairs, "feature string, importance double")
        return frame.orderBy(F.col("importance").desc(), "feature").limit(top_n)

    def info(self) -> DataFrame:
        row = (self.kind, json.dumps(self.metrics), json.dumps(self.best_params), is_forest(self.pipeline.stages[-1]))
        return SparkSession.active().createDataFrame(
            [row], "model_type string, metrics string, best_params string, has_feature_importance boolean"
        )

    def save(self, path: str) -> str:
        """Pipeline directory plus a one-row table with the metadata."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        meta = [(self.kind, json.dumps(asdict(self.state)), json.dumps(self.metrics), json.dumps(self.best_params))]
        frame = SparkSession.active().createDataFrame(meta, "kind string, state string, metrics string, best_params string")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "QualityModel":
        row = spark.read.parquet(f"{path}/metadata").first()
        return cls(
            row["kind"], PipelineModel.load(f"{path}/pipeline"), FeatureState(**json.loads(row["state"])),
            json.loads(row["metrics"]), json.loads(row["best_params"]),
        )


def train(matrix: DataFrame, state: FeatureState, kind: str, **settings) -> QualityModel:
    """Fit scaler and regressor on the labelled rows of ``matrix``."""
    labelled = matrix.where(F.col("label").isNotNull())
    stages = [*scaling_stages(state.columns, labelled.count()), make_regressor(kind, **settings)]
    return QualityModel(kind, Pipeline(stages=stages).fit(labelled), state)


def scale_first(matrix: DataFrame, state: FeatureState) -> PipelineModel:
    """Scaling fitted on the given rows only, for use before a split."""
    return Pipeline(stages=scaling_stages(state.columns, matrix.count())).fit(matrix)


def train_and_evaluate(
    matrix: DataFrame,
    state: FeatureState,
    kind: str,
    fractions: Mapping[str, float] | None = None,
    scale_on: str = "train",
    **settings,
) -> tuple[QualityModel, DataFrame]:
    """Split, fit on the training part, and report the metrics of every part.

    ``scale_on="all"`` fits the scaler before the split, training rows or not.
    """
    parts = split_sets(matrix.where(F.col("label").isNotNull()), fractions).persist()
    try:
        return _fit_and_report(parts, state, kind, scale_on, settings)
    finally:
        parts.unpersist()


def _fit_and_report(parts: DataFrame, state: FeatureState, kind: str, scale_on: str, settings: Mapping) -> tuple[QualityModel, DataFrame]:
    training = parts.where(F.col("set") == "train")
    if scale_on == "all":
        scaler = scale_first(parts, state)
        regressor = make_regressor(kind, **settings).fit(scaler.transform(training))
        model = QualityModel(kind, PipelineModel([*scaler.stages, regressor]), state)
    elif scale_on == "train":
        model = train(training, state, kind, **settings)
    else:
        raise ValueError(f"scale_on must be 'train' or 'all', not {scale_on!r}")
    report = metrics_by_set(model.predict(parts, clipped=False))
    rows = report.collect()
    model.metrics = {f"{r['set']}_{m}": r[m] for r in rows for m in METRICS}
    return model, parts.sparkSession.createDataFrame(rows, report.schema)


def compare_models(
    matrix: DataFrame, state: FeatureState, kinds: Sequence[str] = ("linear", "ridge", "random_forest"), **settings
) -> tuple[str, DataFrame]:
    """Metrics of several model types on one split, and the name of the one with the best test R²."""
    parts = split_sets(matrix.where(F.col("label").isNotNull())).persist()
    try:
        reports = [
            _fit_and_report(parts, state, kind, "train", settings.get(kind, {}))[1].withColumn("model", F.lit(kind)) for kind in kinds
        ]
    finally:
        parts.unpersist()
    table = reduce(DataFrame.unionByName, reports)
    best = table.where(F.col("set") == "test").orderBy(F.col("r2").desc(), "model").first()["model"]
    return best, table


# Tuning and validation


def parameter_grid(kind: str, estimator: Estimator, grid: Mapping[str, Sequence] | None = None) -> list[dict]:
    """Default grids: five ridge penalties; trees x depth x leaf size for forests; none for linear models."""
    if grid is None:
        grid = {"ridge": {"alpha": RIDGE_ALPHAS}, "random_forest": FOREST_GRID}.get(kind, {})
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def grid_search(
    matrix: DataFrame,
    state: FeatureState,
    kind: str,
    folds: int = 5,
    test_fraction: float = 0.2,
    grid: Mapping[str, Sequence] | None = None,
    parallelism: int = 4,
) -> QualityModel:
    """Cross-validated choice by R², refit on the training part, metrics on the held-out part.

    Without a grid the model is just fitted.  Folds follow hashed keys, so they are the same on every run.
    """
    parts = split_sets(
        matrix.where(F.col("label").isNotNull()), {"train": 1 - test_fraction, "test": test_fraction}
    ).withColumn("_fold", fold_of("item_id", folds))
    parts = parts.persist()
    try:
        return _searched(parts, state, kind, folds, grid, parallelism)
    finally:
        parts.unpersist()


def _searched(
    parts: DataFrame, state: FeatureState, kind: str, folds: int, grid: Mapping[str, Sequence] | None, parallelism: int
) -> QualityModel:
    training = parts.where(F.col("set") == "train")
    estimator = make_regressor(kind)
    params = parameter_grid(kind, estimator, grid)
    pipeline = Pipeline(stages=[*scaling_stages(state.columns, training.count()), estimator])
    best_params, best_score = {}, None
    alphas = [p[estimator.alpha] for p in params if set(p) == {getattr(estimator, "alpha", None)}]
    if params == [{}]:
        fitted = pipeline.fit(training)
    elif len(alphas) == len(params):
        # Every penalty and fold from the triangles of the folds, which one pass makes.
        triangles = part_triangles(training, state.columns, "label", [F.col("_fold"), F.lit(0)])
        fits = pd.DataFrame(fold_fits(triangles, folds, {str(i): a for i, a in enumerate(alphas)}), columns=FIT_COLUMNS)
        means = fits[fits["set"] == "test"].groupby("model")["r2"].mean()
        best = max(range(len(alphas)), key=lambda i: (means[str(i)], -i))
        best_params, best_score = {"alpha": alphas[best]}, float(means[str(best)])
        fitted = pipeline.fit(training, params[best])
    else:
        # The scaler is part of what each fold fits, so a fold's held-out rows never shape it.
        search = CrossValidator(
            estimator=pipeline, estimatorParamMaps=params, evaluator=RegressionEvaluator(metricName="r2"),
            numFolds=folds, foldCol="_fold", parallelism=parallelism,
        )
        result = search.fit(training)
        fitted = result.bestModel
        best_score = max(result.avgMetrics)
        best_params = {p.name: v for p, v in params[result.avgMetrics.index(best_score)].items()}
    model = QualityModel(kind, fitted, state, best_params=best_params)
    held_out = metrics_by_set(model.predict(parts.where(F.col("set") == "test"), clipped=False)).first()
    if held_out is not None:
        model.metrics = {m: held_out[m] for m in METRICS}
    if best_score is not None:
        model.metrics["cv_score"] = best_score
    return model


def _fold_metrics(rows: DataFrame, state: FeatureState, estimator: Estimator, fold: int) -> list[tuple[str, float, float]]:
    """Scaler and model learn from the other folds only."""
    training = rows.where(F.col("_fold") != fold)
    model = Pipeline(stages=[*scaling_stages(state.columns, training.count()), estimator]).fit(training)
    side = F.when(F.col("_fold") == fold, "test").otherwise("train")
    found = metrics_by_set(model.transform(rows).withColumn("set", side)).collect()
    return [(r["set"], r["r2"], r["rmse"]) for r in found]


def _fold_table(matrix: DataFrame, folds: int) -> DataFrame:
    return matrix.where(F.col("label").isNotNull()).withColumn("_fold", fold_of("item_id", folds)).persist()


def _fit_all(tasks: Sequence[tuple], parallelism: int) -> list[tuple]:
    """Metrics of independent fits ``(labels, rows, state, estimator, fold)``, several Spark jobs at a time."""

    def run(task):
        labels, *fit = task
        return [(*labels, *values) for values in _fold_metrics(*fit)]

    with ThreadPool(parallelism) as pool:
        return [row for rows in pool.map(inheritable_thread_target(tasks[0][1].sparkSession)(run), tasks) for row in rows]


def cv_report(
    matrix: DataFrame,
    state: FeatureState,
    kinds: Mapping[str, Mapping] | Sequence[str],
    folds: int = 5,
    parallelism: int = 4,
) -> DataFrame:
    """R² and RMSE of every model, fold and side: ``model, fold, set, r2, rmse``.

    All linear and ridge fits come from one pass over the table; forests are fitted fold by fold.
    """
    table = _fold_table(matrix, folds)
    settings = kinds if isinstance(kinds, Mapping) else {kind: {} for kind in kinds}
    alphas = {kind: options.get("alpha", LINEAR_KINDS[kind]) for kind, options in settings.items() if kind in LINEAR_KINDS}
    tasks = [
        ((kind, fold), table, state, make_regressor(kind, **options), fold)
        for kind, options in settings.items()
        if kind not in alphas
        for fold in range(folds)
    ]
    try:
        rows = _fit_all(tasks, parallelism) if tasks else []
        if alphas:
            triangles = part_triangles(table, state.columns, "label", [F.col("_fold"), F.lit(0)])
            rows += [(kind, fold, side, r2, rmse) for kind, _, fold, side, _, r2, rmse in fold_fits(triangles, folds, alphas)]
    finally:
        table.unpersist()
    return matrix.sparkSession.createDataFrame(rows, "model string, fold int, set string, r2 double, rmse double")


def cv_summary(report: DataFrame) -> DataFrame:
    """Mean and population standard deviation over the folds."""
    return report.groupBy("model", "set").agg(
        F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"), F.avg("rmse").alias("rmse_mean")
    )


def learning_curve(
    matrix: DataFrame,
    state: FeatureState,
    kind: str,
    fractions: Sequence[float] = (0.1, 0.325, 0.55, 0.775, 1.0),
    folds: int = 5,
    parallelism: int = 4,
    **settings,
) -> DataFrame:
    """Mean and spread of R² as the training part grows: nested subsets by hashed key.

    For linear and ridge models one pass makes a triangle per fold and share, of which every fit is merged.
    """
    folded = _fold_table(matrix, folds)
    shared = folded.withColumn("_share", hash60("item_id", F.lit("curve")) / float(1 << 60))
    if kind in LINEAR_KINDS:
        try:
            ordered = sorted(fractions)
            triangles = part_triangles(shared, state.columns, "label", [F.col("_fold"), share_of(F.col("_share"), ordered)])
        finally:
            folded.unpersist()
        fits = fold_fits(triangles, folds, {kind: settings.get("alpha", LINEAR_KINDS[kind])}, len(ordered))
        return _curve(matrix.sparkSession, [(ordered[share], fold, side, r2, rmse) for _, share, fold, side, _, r2, rmse in fits])
    tasks = [
        (
            (fraction, fold),
            shared.where((F.col("_fold") == fold) | (F.col("_share") <= fraction)),
            state,
            make_regressor(kind, **settings),
            fold,
        )
        for fraction in fractions
        for fold in range(folds)
    ]
    try:
        rows = _fit_all(tasks, parallelism)
    finally:
        folded.unpersist()
    return _curve(matrix.sparkSession, rows)


def _curve(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    table = spark.createDataFrame(rows, "fraction double, fold int, set string, r2 double, rmse double")
    return table.groupBy("fraction", "set").agg(F.avg("r2").alias("r2_mean"), F.stddev_pop("r2").alias("r2_std"))
