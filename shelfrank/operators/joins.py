"""Key alignment, title lookups and item-id set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.text import match_key, title_contains, title_equals
from shelfrank.scale import join_small, salted_lookup_join

TITLES_PER_PASS = 100


def align_embeddings(items: DataFrame, embeddings: DataFrame, strict: bool = True) -> DataFrame:
    """Items with their vector, matched by ``item_id``; ``strict`` refuses items that have none."""
    if strict:
        uncovered = items.join(embeddings.select("item_id"), "item_id", "left_anti").limit(1).count()
        if uncovered:
            raise ValueError("some items have no embedding")
    return items.join(embeddings.select("item_id", "embedding"), "item_id")


def attach_columns(left: DataFrame, catalog: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Left join of catalog columns by item."""
    return left.join(catalog.select("item_id", *columns), "item_id", "left")


def rows_by_id(catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """Catalog rows of an id table, whose size decides how they are joined."""
    return join_small(catalog, ids.select("item_id").distinct(), how="left_semi")


def _first_match(query: str, name: str, regex: bool) -> Column:
    title = F.col(name)
    exact = F.min(F.when(title_equals(title, query), F.col("item_id")))
    partial = F.min(F.when(title_contains(title, query, regex), F.col("item_id")))
    return F.coalesce(exact, partial)


def resolve_titles(
    catalog: DataFrame, titles: Sequence[str], name: str = "names", regex: bool = False
) -> DataFrame:
    """First item for each asked title: case-insensitive equality, else containment; NULL when nothing matches.

    All titles are looked up in one scan by conditional minima, which shuffles one row per task.
    """
    parts = None
    for start in range(0, len(titles), TITLES_PER_PASS):
        chunk = list(titles)[start : start + TITLES_PER_PASS]
        row = catalog.agg(*[_first_match(q, name, regex).alias(f"t{i}") for i, q in enumerate(chunk)])
        pairs = [
            F.struct(F.lit(start + i).alias("position"), F.lit(q).alias("query"), F.col(f"t{i}").alias("item_id"))
            for i, q in enumerate(chunk)
        ]
        part = row.select(F.inline(F.array(*pairs)))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        return catalog.sparkSession.createDataFrame([], "position int, query string, item_id bigint")
    return parts


def title_suggestions(
    catalog: DataFrame, query: str, n: int = 5, name: str = "names", regex: bool = False
) -> DataFrame:
    """The first ``n`` titles that contain the query, in item order."""
    return catalog.where(title_contains(F.col(name), query, regex)).select("item_id", name).orderBy("item_id").limit(n)


def cluster_ids_of_titles(catalog: DataFrame, titles: Sequence[str], name: str = "names") -> DataFrame:
    """Last item whose normalised title equals each asked title; titles without one are left out."""
    spark = catalog.sparkSession
    wanted = spark.createDataFrame([(t,) for t in dict.fromkeys(titles)], "query string")
    keyed = F.broadcast(wanted.withColumn("_key", match_key(F.col("query"))))
    items = catalog.select("item_id", match_key(F.col(name)).alias("_key"))
    return items.join(keyed, "_key").groupBy("query").agg(F.max("item_id").alias("item_id"))


def last_score_per_title(scored: DataFrame, score: str, name: str = "names") -> DataFrame:
    """One score per normalised title; of several items with the title the last one counts."""
    keyed = scored.select(match_key(F.col(name)).alias("title_key"), score, "item_id")
    return keyed.groupBy("title_key").agg(F.max_by(score, "item_id").alias(score))


def score_by_title(
    rows: DataFrame, scored: DataFrame, score: str, default: float = 0.0, name: str = "names"
) -> DataFrame:
    """Give every row the score of its title; titles without a score get the default.  Safe for frequent titles."""
    keyed = rows.withColumn("title_key", match_key(F.col(name)))
    joined = salted_lookup_join(keyed, last_score_per_title(scored, score, name), "title_key", "item_id")
    return joined.withColumn(score, F.coalesce(F.col(score), F.lit(default))).drop("title_key")


def score_by_id(rows: DataFrame, scored: DataFrame, score: str, default: float = 0.0) -> DataFrame:
    """Scores of the items present in ``scored``; all others keep the default."""
    joined = rows.join(scored.select("item_id", score), "item_id", "left")
    return joined.withColumn(score, F.coalesce(F.col(score), F.lit(default)))


def id_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("item_id").union(b.select("item_id")).distinct()


def id_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("item_id").join(b.select("item_id"), "item_id", "left_anti")


def id_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("item_id").join(b.select("item_id"), "item_id", "left_semi")


def lists_overlap(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))
