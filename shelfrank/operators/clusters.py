"""K-means clusters and the cluster-affinity score."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions.vectors import euclidean
from shelfrank.operators.projections import CLUSTERING_COLUMNS, any_null, non_members
from shelfrank.operators.ranking import top_n
from shelfrank.scale import broadcast_bounded, broadcast_if_small, collect_bounded, cut_lineage, join_small

CLUSTERS = 30
SEED = 42
TOLERANCE = 1e-4
SWEEP = (10, 20, 30, 40, 50)
MAX_REFERENCES = 10_000
MAX_CLUSTERS = 100_000
ROWS_PER_BLOCK = 4096
MAX_BLOCKS = 32
VALUES_PER_BLOCK = 1 << 21
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 16
#: Squared distances below this share of the squared lengths are measured again, as their last digits cancel.
NEAR = 1e-6


class ItemClusterer:
    """K-means over numeric columns, unscaled by default.

    Rows with a missing feature cannot be placed: ``assignments`` leaves them out, ``unplaced`` lists them.
    """

    def __init__(
        self,
        features: Sequence[str] = CLUSTERING_COLUMNS,
        clusters: int = CLUSTERS,
        seed: int = SEED,
        scale: bool = False,
        max_iter: int = 300,
    ):
        self.features = list(features)
        self.clusters = clusters
        self.seed = seed
        self.scale = scale
        self.max_iter = max_iter
        self.model: PipelineModel | None = None
        self._data: DataFrame | None = None

    def fit(self, df: DataFrame) -> "ItemClusterer":
        stages = [VectorAssembler(inputCols=self.features, outputCol="_raw", handleInvalid="skip")]
        if self.scale:
            stages.append(StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True))
        inputs = "_scaled" if self.scale else "_raw"
        tolerance = self._tolerance(df)
        stages.append(
            KMeans(
                k=self.clusters, seed=self.seed, maxIter=self.max_iter, tol=tolerance, featuresCol=inputs,
                predictionCol="cluster_id",
            )
        )
        self.model = Pipeline(stages=stages).fit(df)
        self._data = df
        return self

    def _tolerance(self, df: DataFrame) -> float:
        """Largest centre shift that counts as settled: ``TOLERANCE`` relative to the mean variance of the features."""
        if self.scale:
            return (TOLERANCE / self.clusters) ** 0.5
        spread = df.dropna(subset=self.features).agg(*[F.var_pop(c).alias(c) for c in self.features]).first()
        mean_variance = sum(v or 0.0 for v in spread) / len(self.features)
        return (TOLERANCE * mean_variance / self.clusters) ** 0.5

    def _fitted(self) -> PipelineModel:
        if self.model is None:
            raise ValueError("call fit() before reading clusters")
        return self.model

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with ``cluster_id`` and the vector the clusters were built on as ``features``."""
        placed = self._fitted().transform(df)
        return placed.withColumn("features", vector_to_array("_scaled" if self.scale else "_raw")).drop("_raw", "_scaled")

    @property
    def assignments(self) -> DataFrame:
        self._fitted()
        return self.assign(self._data)

    @property
    def unplaced(self) -> DataFrame:
        """The rows of the fitted table with a missing feature."""
        self._fitted()
        return self._data.where(any_null(self.features))

    @property
    def centroids(self) -> DataFrame:
        centers = self._fitted().stages[-1].clusterCenters()
        rows = [(i, [float(x) for x in center]) for i, center in enumerate(centers)]
        return SparkSession.active().createDataFrame(rows, "cluster_id int, centroid array<double>")

    def save(self, path: str) -> str:
        self._fitted().write().overwrite().save(path)
        return path

    @classmethod
    def load(cls, path: str) -> "ItemClusterer":
        model = PipelineModel.load(path)
        kmeans = model.stages[-1]
        loaded = cls(model.stages[0].getInputCols(), kmeans.getK(), kmeans.getSeed(), scale=len(model.stages) > 2)
        loaded.model = model
        return loaded


def wide_centroids(centroids: DataFrame, features: Sequence[str]) -> DataFrame:
    return centroids.select("cluster_id", *[F.col("centroid")[i].alias(name) for i, name in enumerate(features)])


def mean_centroids(assigned: DataFrame) -> DataFrame:
    """Centroids of given groups: the mean of every ``features`` position."""
    values = assigned.select("cluster_id", F.posexplode("features").alias("position", "v"))
    means = values.groupBy("cluster_id", "position").agg(F.avg(F.col("v").cast("double")).alias("m"))
    # One entry per dimension, so the list of one cluster has a fixed length.
    listed = means.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("position", "m"))).alias("e"))
    return listed.select("cluster_id", F.transform("e", lambda x: x["m"]).alias("centroid"))


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("count")).orderBy("cluster_id")


def cluster_scores(assigned: DataFrame, centroids: DataFrame, references: DataFrame) -> DataFrame:
    """Affinity of every item to the clusters of the reference items: ``item_id, cluster_id, cluster_score`` in 0..100.

    A cluster weighs its share of the references, repeated ids counting each time.  Inside a cluster the score falls
    linearly from the centroid to its farthest member.  References themselves score 0; unknown ids are ignored.
    """
    spark = assigned.sparkSession
    references = broadcast_bounded(references.select("item_id"), MAX_REFERENCES, "reference list")
    referred = join_small(assigned.select("item_id", "cluster_id"), references, max_rows=MAX_REFERENCES)
    counted = referred.groupBy("cluster_id").count()
    members = {r["cluster_id"]: r["count"] for r in collect_bounded(counted, MAX_REFERENCES, "reference clusters")}
    total = sum(members.values())
    if not total:
        return assigned.select("item_id", "cluster_id", F.lit(0.0).alias("cluster_score"))
    involved = collect_bounded(
        centroids.where(F.col("cluster_id").isin(list(members))), MAX_REFERENCES, "reference centroids"
    )
    weights = pa.table(
        {
            "cluster_id": pa.array([r["cluster_id"] for r in involved], pa.int32()),
            "centroid": pa.array([r["centroid"] for r in involved], pa.list_(pa.float64())),
            "weight": pa.array([members[r["cluster_id"]] / total for r in involved], pa.float64()),
        }
    )
    targets = F.broadcast(spark.createDataFrame(weights))
    measured = assigned.select("item_id", "cluster_id", "features").join(targets, "cluster_id", "left")
    measured = measured.withColumn("distance", euclidean(F.col("features"), F.col("centroid"))).drop("features", "centroid")
    # One row per cluster that has references, so never more rows than references.
    reach = measured.where(F.col("weight").isNotNull()).groupBy("cluster_id").agg(F.max("distance").alias("reach"))
    closeness = F.when(F.col("reach") == 0, 1.0).otherwise(1 - F.try_divide(F.col("distance"), F.col("reach")))
    score = F.coalesce(closeness * F.col("weight") * 100, F.lit(0.0))
    is_reference = F.broadcast(references.distinct().withColumn("_ref", F.lit(True)))
    return (
        measured.join(F.broadcast(reach), "cluster_id", "left")
        .join(is_reference, "item_id", "left")
        .select("item_id", "cluster_id", F.when(F.col("_ref"), 0.0).otherwise(score).alias("cluster_score"))
    )


def cluster_report(scores: DataFrame, catalog: DataFrame, references: DataFrame, n: int = 10) -> DataFrame:
    """Reference items, then the ``n`` best other items, with catalog columns; ``role`` tells them apart."""
    columns = ["names", *[c for c in CLUSTERING_COLUMNS if c in catalog.columns]]
    ids = broadcast_bounded(references.select("item_id").distinct(), MAX_REFERENCES, "reference list")
    own = scores.join(ids, "item_id", "left_semi").withColumn("role", F.lit("reference"))
    best = top_n(non_members(scores, ids), "cluster_score", n).withColumn("role", F.lit("recommended"))
    listed = broadcast_if_small(own.unionByName(best))
    details = join_small(catalog.select("item_id", *columns), listed.select("item_id"), how="left_semi")
    return listed.join(details, "item_id", "left")


def silhouette(assigned: DataFrame) -> float:
    """Mean silhouette with squared distances: one pass per cluster statistic, linear in the rows."""
    prepared = assigned.select("cluster_id", array_to_vector("features").alias("features"))
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id").evaluate(prepared)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of all pairs from products of whole matrices; pairs so near that digits cancel are measured again by their differences."""
    squares_x, squares_y = (x * x).sum(axis=1), (y * y).sum(axis=1)
    both = squares_x[:, None] + squares_y[None, :]
    squares = both - 2 * (x @ y.T)
    rows, columns = np.nonzero(squares <= NEAR * both)
    for at in range(0, len(rows), PAIRS_AT_ONCE):
        i, j = rows[at : at + PAIRS_AT_ONCE], columns[at : at + PAIRS_AT_ONCE]
        squares[i, j] = ((x[i] - y[j]) ** 2).sum(axis=1)
    return np.sqrt(squares, out=squares)


def euclidean_silhouette(assigned: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Mean silhouette with plain distances, as one row.

    Every row needs its mean distance to each cluster, so all pairs are measured, each once: block by block, and a task emits one
    distance sum per row and cluster of the other block, never a pair.  There are at most ``MAX_BLOCKS`` blocks until one holds
    ``VALUES_PER_BLOCK`` values, so up to there rows travel a fixed number of times.
    """
    total, width = assigned.agg(F.count(F.lit(1)), F.max(F.size("features"))).first()
    blocks = max(1, min(math.ceil(total / rows_per_block), max(MAX_BLOCKS, math.ceil(total * (width or 1) / VALUES_PER_BLOCK))))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    points = cut_lineage(
        assigned.select("item_id", F.col("cluster_id").cast("int").alias("cluster_id"), "features", block.alias("block")), "silhouette-points"
    )
    meeting = points.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    meeting = meeting.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")

    def measure(table: pa.Table) -> pa.Table:
        ids, own, codes = (table.column(c).to_numpy() for c in ("item_id", "cluster_id", "block"))
        values = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), -1)
        values -= values.mean(axis=0)
        order = np.lexsort((own, codes))
        ids, own, values, codes = ids[order], own[order], values[order], codes[order]
        cut = int(np.searchsorted(codes, codes[0], side="right"))
        same = cut == len(codes)
        # Rows lie in the order of their clusters, so sums over a cluster are sums over a range.
        (x, x_own), (y, y_own) = (values[:cut], own[:cut]), (values, own) if same else (values[cut:], own[cut:])
        x_labels, x_place = np.unique(x_own, return_inverse=True)
        y_labels, y_starts = np.unique(y_own, return_index=True)
        of_x, of_y = np.zeros((len(x), len(y_labels))), np.zeros((len(x_labels), 0 if same else len(y)))
        for at in range(0, len(x), ROWS_AT_ONCE):
            distances = _distances(x[at : at + ROWS_AT_ONCE], y)
            of_x[at : at + ROWS_AT_ONCE] = np.add.reduceat(distances, y_starts, axis=1)
            if not same:
                labels, starts = np.unique(x_place[at : at + ROWS_AT_ONCE], return_index=True)
                of_y[labels] += np.add.reduceat(distances, starts, axis=0)
        sides = [(ids[:cut], x_own, y_labels, of_x)] + ([] if same else [(ids[cut:], y_own, x_labels, of_y.T)])
        made = [(np.repeat(i, len(of)), np.repeat(o, len(of)), np.tile(of, len(i)), sums.ravel()) for i, o, of, sums in sides]
        names = ("item_id", "own", "cluster_id", "distance")
        types = (pa.int64(), pa.int32(), pa.int32(), pa.float64())
        return pa.table({n: pa.array(np.concatenate(c), t) for n, t, c in zip(names, types, zip(*made, strict=True), strict=True)})

    measured = meeting.groupBy("low", "high").applyInArrow(measure, "item_id bigint, own int, cluster_id int, distance double")
    counted = points.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    sizes = broadcast_bounded(counted, MAX_CLUSTERS, "clusters")
    sums = measured.groupBy("item_id", "own", "cluster_id").agg(F.sum("distance").alias("distance")).join(sizes, "cluster_id")
    is_own = F.col("own") == F.col("cluster_id")
    per_item = sums.groupBy("item_id").agg(
        F.max(F.when(is_own, F.col("size"))).alias("own_size"),
        F.max(F.when(is_own, F.try_divide(F.col("distance"), F.col("size") - 1))).alias("a"),
        F.min(F.when(~is_own, F.col("distance") / F.col("size"))).alias("b"),
    )
    value = F.when(F.col("own_size") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return per_item.agg(F.avg(value).alias("silhouette"))


def kmeans_sweep(df: DataFrame, ks: Sequence[int] = SWEEP, **settings) -> DataFrame:
    """Silhouette for each number of clusters."""
    rows = []
    for k in ks:
        clusterer = ItemClusterer(clusters=k, **settings).fit(df)
        rows.append((k, float(silhouette(clusterer.assignments))))
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")
