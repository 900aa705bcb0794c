"""Approximate nearest neighbours: several shifted Hilbert orderings, whose key windows around each query are merged and reranked."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.common import pick, stored
from shelfrank.llm.hilbert import hilbert_positions
from shelfrank.scale import top_k_per_group

CURVES = 24
PROJECTED = 8
BITS = 7
WINDOW_SHARE = 0.03
LEAST_WINDOW = 64
BLOCK = 8192
QUERIES_AT_ONCE = 4096
SAMPLE = 4096
SEED = 4


@dataclass
class Curves:
    """For each curve: a random projection, and per projected coordinate where the grid begins and how wide its cells are."""

    projections: np.ndarray  # curves x dimensions x projected
    begins: np.ndarray  # curves x projected
    widths: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, curves: int = CURVES, projected: int = PROJECTED, bits: int = BITS, seed: int = SEED) -> Curves:
        """Grids that span three standard deviations to both sides of the sample's mean, each moved by a random part of a cell."""
        random = np.random.default_rng(seed)
        dimensions = sample.shape[1]
        projected = min(projected, dimensions)
        turned = [np.linalg.qr(random.normal(size=(dimensions, dimensions)))[0][:, :projected] for _ in range(curves)]
        projections = np.stack(turned)
        places = np.einsum("nd,cdp->cnp", sample, projections)
        spread = np.maximum(places.std(axis=1), 1e-12)
        widths = 6 * spread / 2**bits
        # A shift by up to a fifth of the grid moves every border of the curve's sub-cubes.
        begins = places.mean(axis=1) - 3 * spread - random.random(spread.shape) * 1.2 * spread
        return cls(projections, begins, widths)

    def keys(self, vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
        """Position of each vector on each curve (vectors x curves); what lies beyond the grid counts to its border cells."""
        out = np.empty((len(vectors), len(self.projections)), dtype=np.int64)
        for c, projection in enumerate(self.projections):
            cells = np.floor((vectors @ projection - self.begins[c]) / self.widths[c])
            out[:, c] = hilbert_positions(np.clip(cells, 0, 2**bits - 1).astype(np.int64), bits)
        return out


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_by_curves(
    df: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int = CURVES,
    share: float = WINDOW_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """query_id, rank, the neighbour's id and its Euclidean distance, for every row for which ``is_query`` (an expression of ``id``) holds.

    Every row but the query's own may be found.  On each curve a query meets the rows whose position is at most
    max(64, ``share`` of all rows) away from its own; all that it meets are compared exactly, in double precision, on the whole vectors.  A
    fixed share is what keeps the recall the same for any number of vectors without structure.  Ties go to the smaller id.

    Rows that are null, zero or not finite, those of another length than most rows, and null ids take no part.  Rows with equal
    id and vector count once.  Equal vectors are one point on the curves, with its ``k + 1`` smallest ids, so any
    number of copies neither fills a window nor a task.  With fewer than ``k`` candidates all are returned; an empty table gives an
    empty result; other columns are ignored.
    """
    id_type = dict(df.dtypes)[id_col]
    rows = pick(df, id=id_col, vector=vector_col).where(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dimension = sizes[0]["n"] if sizes else 1
    rows = rows.where(F.size("vector") == dimension).select(
        "id", "vector", F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2"), is_query.alias("asks")
    )
    groups = rows.groupBy("h1", "h2").agg(
        F.min("id").alias("point"), F.max("id").alias("last"), F.max("asks").alias("asks"), F.first("vector").alias("vector")
    )
    points = stored(groups, "points")
    several = stored(points.where("point <> last").select("h1", "h2", "point"), "copied-points")
    copies = rows.select("h1", "h2", "id").join(several, ["h1", "h2"]).select("point", "id").distinct()
    members = top_k_per_group(copies, ["point"], [F.col("id")], k + 1, "id").select("point", "id")
    members = points.where("point = last").select("point", F.col("point").alias("id")).unionByName(members)

    n_points = points.count()
    sample = points.select("point", "vector").orderBy(F.xxhash64("point"), "point").limit(SAMPLE).toPandas()
    if not len(sample):
        return df.sparkSession.createDataFrame([], f"query_id {id_type}, rank int, {id_col} {id_type}, score double")
    fitted = Curves.fit(np.stack(sample["vector"]).astype(np.float64), curves, seed=seed)
    window = max(LEAST_WINDOW, math.ceil(share * n_points))
    ranked = _ranked(points, fitted, id_type)
    found = _met(ranked, n_points, window, k + 1, id_type)

    best = Window.partitionBy("query").orderBy("score", "point")
    found = found.dropDuplicates(["query", "point"]).withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1)
    answers = stored(found.select("query", "point", "score").join(members.withColumnRenamed("id", "found"), "point"), "curve-answers")
    asked = rows.where("asks").select("h1", "h2", F.col("id").alias("query_id")).distinct()
    asked = stored(asked.join(points.select("h1", "h2", F.col("point").alias("query")), ["h1", "h2"]), "asked")
    order = Window.partitionBy("query_id", "query").orderBy("score", "found")
    return (
        asked.select("query_id", "query")
        .join(answers.select("query", "found", "score"), "query")
        .where("query_id <> found")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("found").alias(id_col), "score")
    )


def _ranked(points: DataFrame, fitted: Curves, id_type: str) -> DataFrame:
    """Every point once for each curve, with its place among all points of that curve.

    Range partitioning by curve and key sorts the whole table; the place is the number of rows in the partitions before and the
    place inside the partition.
    """
    shared = points.sparkSession.sparkContext.broadcast(fitted)
    vector_type = dict(points.dtypes)["vector"]

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                keys = shared.value.keys(np.stack(batch["vector"]).astype(np.float64))
                for curve in range(keys.shape[1]):
                    yield batch.assign(curve=curve, key=keys[:, curve])

    schema = f"point {id_type}, vector {vector_type}, asks boolean, curve int, key long"
    order = ["curve", "key", "point"]
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = points.select("point", "vector", "asks").mapInPandas(keyed, schema).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = stored(ordered.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}).drop("key"), "curve-order")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts_of = placed.groupBy("curve", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
    starts = parts_of.select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    # One row for each pair of curve and partition that meet: partitions and curves in all.
    return placed.join(F.broadcast(starts), ["curve", "part"]).select("curve", "point", "vector", "asks", (F.col("row") + F.col("shift")).alias("place"))


def _met(ranked: DataFrame, n_points: int, window: int, k: int, id_type: str) -> DataFrame:
    """For each query and each block of places that its window reaches, the ``k`` nearest rows inside the window."""
    chunks = math.ceil((2 * window + BLOCK) / QUERIES_AT_ONCE)
    last = (n_points - 1) // BLOCK
    data = ranked.withColumn("block", F.floor(F.col("place") / BLOCK)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    low, high = F.floor((F.col("place") - window) / BLOCK), F.floor((F.col("place") + window) / BLOCK)
    reached = F.sequence(F.greatest(low, F.lit(0)), F.least(high, F.lit(last)))
    queries = ranked.where("asks").withColumn("chunk", F.pmod(F.xxhash64("point"), F.lit(chunks)).cast("int")).withColumn("block", F.explode(reached))
    columns = ["query", "point", "score"]

    def nearest(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(there):
            return pd.DataFrame(columns=columns)
        there = there.sort_values("there_place")
        vectors, places, ids = np.stack(there["there_vector"]).astype(np.float64), there["there_place"].to_numpy(), there["there_point"].to_numpy()
        out = []
        for point, vector, place in zip(asking["point"], asking["vector"], asking["place"], strict=True):
            a, b = np.searchsorted(places, [place - window, place + window + 1])
            difference = vectors[a:b] - np.asarray(vector, dtype=np.float64)
            distance = np.sqrt(np.square(difference).sum(axis=1))
            kept = np.lexsort((ids[a:b], distance))[:k] if b - a <= 4 * k else _first(distance, ids[a:b], k)
            out.append(pd.DataFrame({"query": point, "point": ids[a:b][kept], "score": distance[kept]}))
        return pd.concat(out)[columns]

    key, carried = ["curve", "block", "chunk"], ["point", "vector", "place"]
    asking = queries.select(*key, *carried).groupBy(*key)
    there = data.toDF(*[f"_{c}" for c in data.columns])
    there = there.select(*[F.col(f"_{c}").alias(f"_{c}") for c in key], *[F.col(f"_{c}").alias(f"there_{c}") for c in carried])
    pairs = asking.cogroup(there.groupBy(*[f"_{c}" for c in key]))
    return pairs.applyInPandas(nearest, f"query {id_type}, point {id_type}, score double")


def _first(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` first by distance, then id."""
    near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    return near[np.lexsort((ids[near], distance[near]))[:k]]
