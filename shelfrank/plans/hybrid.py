"""The hybrid ranking: similarity, predicted quality and cluster affinity in one weighted score."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.text import match_key
from shelfrank.operators.clusters import cluster_scores
from shelfrank.operators.joins import cluster_ids_of_titles, id_difference, id_union, resolve_titles, score_by_id
from shelfrank.operators.ranking import best_per_title, top_n
from shelfrank.operators.similarity import item_queries, nearest
from shelfrank.scale import broadcast_if_small, cut_lineage, join_small

WEIGHTS = {"similarity": 0.6, "quality": 0.2, "cluster": 0.2}
CANDIDATES = 50
MIN_CLUSTER_SCORE = 0.1
COLUMNS = ("names", "year", "final_score", "sim_score_norm", "quality_score_pred", "cluster_score")
MAX_POOL = 10_000


def semantic_candidates(
    catalog: DataFrame, items: DataFrame, resolved: DataFrame, n: int = CANDIDATES, dedupe: bool = True
) -> DataFrame:
    """The ``n`` nearest items of every resolved title, best row per title, similarity in percent."""
    queries = item_queries(items, resolved.select("query", "item_id").distinct())
    ranked = nearest(items, queries, n).groupBy("item_id").agg(F.max("similarity").alias("similarity"))
    best = join_small(catalog.select("item_id", "names"), ranked, max_rows=MAX_POOL)
    if dedupe:
        best = best_per_title(best, "similarity")
    return best.select("item_id", (F.col("similarity") * 100).alias("sim_score_norm"))


def cluster_candidates(scores: DataFrame, n: int = CANDIDATES, minimum: float = MIN_CLUSTER_SCORE) -> DataFrame:
    return top_n(scores.where(F.col("cluster_score") > minimum), "cluster_score", n).select("item_id")


def candidate_pool(semantic: DataFrame, clustered: DataFrame, references: DataFrame) -> DataFrame:
    """Items of either list that are not references."""
    return id_difference(id_union(semantic, clustered), references)


class HybridRecommender:
    """Ranks catalog items for reference titles.

    ``catalog`` has ``item_id`` and ``names``; ``items`` has ``item_id`` and ``embedding``.  ``quality`` maps candidate rows
    to ``(item_id, quality_score_pred)``, for example ``QualityModel.score_items``.  ``assigned`` (``item_id, cluster_id,
    features``) and ``centroids`` are optional; without them the cluster part is 0.
    """

    def __init__(
        self,
        catalog: DataFrame,
        items: DataFrame,
        quality: Callable[[DataFrame], DataFrame],
        assigned: DataFrame | None = None,
        centroids: DataFrame | None = None,
    ):
        for part, name in ((catalog, "catalog"), (items, "embeddings"), (quality, "quality model")):
            if part is None:
                raise ValueError(f"{name} is required")
        self.catalog = catalog
        self.items = items
        self.quality = quality
        self.assigned = assigned
        self.centroids = centroids

    def cluster_scores(self, titles: Sequence[str]) -> DataFrame | None:
        if self.assigned is None or self.centroids is None:
            return None
        references = cluster_ids_of_titles(self.catalog, titles)
        # Candidates and title lookups both read the scores; written once, the vectors are not measured again.
        return cut_lineage(cluster_scores(self.assigned, self.centroids, references), "cluster-scores")

    def recommend(
        self, titles: Sequence[str], n: int = 10, weights: Mapping[str, float] | None = None, dedupe: bool = True
    ) -> DataFrame:
        """The ``n`` best items by weighted score; empty when no title is known."""
        weights = dict(weights or WEIGHTS)
        resolved = broadcast_if_small(resolve_titles(self.catalog, titles))
        references = resolved.where(F.col("item_id").isNotNull()).select("item_id").distinct()
        semantic = broadcast_if_small(
            semantic_candidates(self.catalog, self.items, resolved, dedupe=dedupe), MAX_POOL
        )
        scores = self.cluster_scores(titles)
        clustered = cluster_candidates(scores) if scores is not None else semantic.select("item_id").limit(0)
        pool = broadcast_if_small(candidate_pool(semantic, clustered, references), MAX_POOL)
        candidates = score_by_id(join_small(self.catalog, pool, how="left_semi", max_rows=MAX_POOL), semantic, "sim_score_norm")
        if scores is None:
            candidates = candidates.withColumn("cluster_score", F.lit(0.0))
        else:
            candidates = self._scores_by_title(candidates, pool, scores)
        # The pool is small, so its rows are fetched once for both the features and the final score.
        candidates = broadcast_if_small(candidates, MAX_POOL)
        rated = candidates.join(self.quality(candidates), "item_id", "left")
        final = (
            weights["similarity"] * F.col("sim_score_norm")
            + weights["quality"] * F.coalesce("quality_score_pred", F.lit(0.0))
            + weights["cluster"] * F.col("cluster_score")
        )
        ranked = top_n(rated.withColumn("final_score", final), "final_score", n)
        return ranked.select("item_id", *[c for c in COLUMNS if c in ranked.columns])

    def _scores_by_title(self, candidates: DataFrame, pool: DataFrame, scores: DataFrame) -> DataFrame:
        """Cluster score of the last item that carries a candidate's title.

        Only titles of the candidate pool matter, so the catalog is first reduced to them.
        """
        keyed = candidates.withColumn("title_key", match_key(F.col("names")))
        titled = self.catalog.select("item_id", match_key(F.col("names")).alias("title_key"))
        wanted = join_small(titled, pool, how="left_semi", max_rows=MAX_POOL).select("title_key").distinct()
        same_title = titled.join(broadcast_if_small(wanted, MAX_POOL), "title_key", "left_semi")
        scored = same_title.join(scores.select("item_id", "cluster_score"), "item_id")
        last = scored.groupBy("title_key").agg(F.max_by("cluster_score", "item_id").alias("cluster_score"))
        joined = keyed.join(last, "title_key", "left").drop("title_key")
        return joined.withColumn("cluster_score", F.coalesce("cluster_score", F.lit(0.0)))


def score_breakdown(recommended: DataFrame, weights: Mapping[str, float] | None = None, n: int = 5) -> DataFrame:
    """Weighted contribution of each component for the ``n`` best items."""
    weights = dict(weights or WEIGHTS)
    parts = {
        "similarity_part": F.col("sim_score_norm") * weights["similarity"],
        "quality_part": F.col("quality_score_pred") * weights["quality"],
        "cluster_part": F.col("cluster_score") * weights["cluster"],
    }
    return top_n(recommended.withColumns(parts), "final_score", n).select("item_id", "names", "final_score", *parts)
