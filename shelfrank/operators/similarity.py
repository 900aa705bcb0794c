"""Cosine similarity search over ``(item_id, embedding ARRAY<FLOAT>)`` tables.

Queries are few and travel to the data: every task multiplies its Arrow batches with the query matrix and emits only
its own best ``k`` rows per query.  Similarities are rounded to ``SIM_DECIMALS`` before ranking, so that equal vectors
tie exactly and ties go to the smaller item id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.text import first_genre
from shelfrank.functions.vectors import cosine
from shelfrank.operators.joins import resolve_titles
from shelfrank.operators.ranking import MAX_BROADCAST_PAIRS, hash_sample, hash_sample_per_group, n_largest, random_pairs
from shelfrank.scale import broadcast_if_small, collect_bounded, cut_lineage, join_small, top_k_per_group

SIM_DECIMALS = 9
MAX_QUERIES = 10_000
QUERY_CHUNK = 256
ROWS_PER_BLOCK = 4096
MAX_PIVOTS = 512
MAX_BLOCKS = 32
VALUES_PER_BLOCK = 1 << 21
DISPLAY = ("names", "similarity", "score", "year", "genre", "overview")
OVERLAP_TIERS = ((7, "strong"), (4, "moderate"))


@dataclass(frozen=True)
class Query:
    """A vector to search with; the item it belongs to, if any, is not a result of its own search."""

    name: str
    vector: Sequence[float]
    item_id: int | None = None


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """Arrow list column to a float64 matrix with rows of length 1; zero rows stay zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    count = len(vectors)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if count and flat.size % count:
        raise ValueError("vectors must all have the same length")
    return normalized(flat.reshape(count, -1) if count else flat.reshape(0, 0))


def normalized(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def best_rows(similarities: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best entries; equal similarities by id."""
    if len(similarities) > k:
        cutoff = np.partition(similarities, len(similarities) - k)[len(similarities) - k]
        positions = np.flatnonzero(similarities >= cutoff)
    else:
        positions = np.arange(len(similarities))
    order = np.lexsort((ids[positions], -similarities[positions]))[:k]
    return positions[order]


def best_per_row(
    similarities: np.ndarray, row_ids: np.ndarray, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row and column positions of the ``k`` best entries of every row, without the row's own item; ties by id."""
    similarities[row_ids[:, None] == ids[None, :]] = -np.inf
    wanted = similarities > -np.inf
    width = similarities.shape[1]
    if width > k:
        wanted &= similarities >= np.partition(similarities, width - k, axis=1)[:, width - k, None]
    rows, columns = np.nonzero(wanted)
    order = np.lexsort((ids[columns], -similarities[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    position = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
    return rows[position < k], columns[position < k]


def _with_vector(items: DataFrame) -> DataFrame:
    return items.where(F.col("embedding").isNotNull()).select("item_id", "embedding")


def nearest(items: DataFrame, queries: Sequence[Query], k: int) -> DataFrame:
    """The ``k`` most similar items of every query: ``query, item_id, similarity, rank``."""
    schema = "query string, item_id bigint, similarity double"
    if not queries:
        return items.sparkSession.createDataFrame([], f"{schema}, rank int")
    matrix = normalized(np.array([q.vector for q in queries], dtype=np.float64))
    names = [q.name for q in queries]
    own = np.array([-1 if q.item_id is None else q.item_id for q in queries], dtype=np.int64)
    is_item = np.array([q.item_id is not None for q in queries])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in names]
        for batch in batches:
            ids = batch.column("item_id").to_numpy(zero_copy_only=False)
            rows = unit_rows(batch.column("embedding"))
            for start in range(0, len(names), QUERY_CHUNK):
                block = matrix[start : start + QUERY_CHUNK]
                scores = np.round(rows @ block.T, SIM_DECIMALS) if len(ids) else np.empty((0, len(block)))
                for i in range(len(block)):
                    q = start + i
                    usable = ids != own[q] if is_item[q] else slice(None)
                    sims = np.concatenate([kept[q][0], scores[usable, i]])
                    merged = np.concatenate([kept[q][1], ids[usable]])
                    best = best_rows(sims, merged, k)
                    kept[q] = (sims[best], merged[best])
        sizes = [len(found[1]) for found in kept]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(names, dtype=object), sizes), pa.string()),
                pa.array(np.concatenate([found[1] for found in kept]), pa.int64()),
                pa.array(np.concatenate([found[0] for found in kept]), pa.float64()),
            ],
            names=["query", "item_id", "similarity"],
        )

    partial = _with_vector(items).mapInArrow(search, schema)
    return top_k_per_group(partial, ["query"], [F.col("similarity").desc(), F.col("item_id")], k, "item_id")


def item_queries(items: DataFrame, resolved: DataFrame) -> list[Query]:
    """Queries for resolved titles (``query, item_id``); titles without an item or without a vector are left out."""
    wanted = resolved.where(F.col("item_id").isNotNull()).select("query", "item_id")
    found = join_small(_with_vector(items), wanted, max_rows=MAX_QUERIES)
    rows = collect_bounded(found, MAX_QUERIES, "query set")
    return [Query(r["query"], r["embedding"], r["item_id"]) for r in sorted(rows, key=lambda r: (r["query"], r["item_id"]))]


def with_catalog(ranked: DataFrame, catalog: DataFrame, with_scores: bool = True) -> DataFrame:
    """Attach the display columns that the catalog has to a ranked result."""
    columns = [c for c in DISPLAY if c in catalog.columns and c not in ranked.columns]
    joined = join_small(catalog.select("item_id", *columns), ranked, max_rows=MAX_QUERIES * 10)
    return joined if with_scores else joined.drop("similarity")


def similar_items(catalog: DataFrame, items: DataFrame, title: str, k: int = 10, with_scores: bool = True) -> DataFrame:
    """Items most similar to the item a title resolves to; empty when nothing matches the title."""
    return batch_similar(catalog, items, [title], k, with_scores)


def batch_similar(
    catalog: DataFrame, items: DataFrame, titles: Sequence[str], k: int = 10, with_scores: bool = True
) -> DataFrame:
    """The same for many titles; the ``query`` column tells the results apart.

    Each ``MAX_QUERIES`` titles take one scan of the vectors; a longer list takes several.
    """
    different = list(dict.fromkeys(titles))
    parts = [different[i : i + MAX_QUERIES] for i in range(0, len(different), MAX_QUERIES)] or [[]]
    found = []
    for part in parts:
        queries = item_queries(items, resolve_titles(catalog, part).select("query", "item_id").distinct())
        found.append(with_catalog(nearest(items, queries, k), catalog, with_scores))
    return reduce(DataFrame.unionByName, found)


def pair_similarity(catalog: DataFrame, items: DataFrame, title_a: str, title_b: str) -> DataFrame:
    """Similarity of two titles as one row; NULL when either is unknown."""
    resolved = resolve_titles(catalog, [title_a, title_b])
    found = {q.name: q for q in item_queries(items, resolved.select("query", "item_id").distinct())}
    value = None
    if title_a in found and title_b in found:
        a, b = (normalized(np.array([found[t].vector], dtype=np.float64))[0] for t in (title_a, title_b))
        value = float(np.round(a @ b, SIM_DECIMALS))
    return catalog.sparkSession.createDataFrame(
        [(title_a, title_b, value)], "title_a string, title_b string, similarity double"
    )


def pair_matrix(catalog: DataFrame, items: DataFrame, by: str = "score", n: int = 20) -> DataFrame:
    """Similarity of every pair among the ``n`` best-scored items that have a vector."""
    top = n_largest(catalog.join(_with_vector(items), "item_id"), by, n).select("item_id", "embedding")
    rows = collect_bounded(top, n, "matrix items")
    spark = catalog.sparkSession
    if not rows:
        return spark.createDataFrame([], "id_a bigint, id_b bigint, similarity double")
    ids = [r["item_id"] for r in rows]
    unit = normalized(np.array([r["embedding"] for r in rows], dtype=np.float64))
    values = np.round(unit @ unit.T, SIM_DECIMALS)
    pairs = [(a, b, float(values[i, j])) for i, a in enumerate(ids) for j, b in enumerate(ids)]
    return spark.createDataFrame(pairs, "id_a bigint, id_b bigint, similarity double")


def random_pair_similarity(items: DataFrame, n_pairs: int, seed: int) -> DataFrame:
    """Similarity of random item pairs: ``pair_id, id_a, id_b, similarity``."""
    vectors = _with_vector(items)
    pairs = broadcast_if_small(random_pairs(vectors, n_pairs, seed), MAX_BROADCAST_PAIRS)
    drawn_ids = pairs.select(F.col("id_a").alias("item_id")).union(pairs.select("id_b")).distinct()
    # Only vectors that were drawn take part in the joins.
    drawn = join_small(vectors, drawn_ids, how="left_semi", max_rows=2 * MAX_BROADCAST_PAIRS)
    left = drawn.select(F.col("item_id").alias("id_a"), F.col("embedding").alias("vector_a"))
    right = drawn.select(F.col("item_id").alias("id_b"), F.col("embedding").alias("vector_b"))
    joined = pairs.join(left, "id_a").join(right, "id_b")
    return joined.select("pair_id", "id_a", "id_b", F.round(cosine(F.col("vector_a"), F.col("vector_b")), SIM_DECIMALS).alias("similarity"))


# All pairs


def _assign_cells(items: DataFrame, pivots: np.ndarray, pivot_ids: np.ndarray, k: int) -> DataFrame:
    """Nearest pivot of every vector, the angle to it, and the k-th best similarity among the pivots."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item_id").to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            sims = unit_rows(batch.column("embedding")) @ pivots.T
            cell = sims.argmax(axis=1)
            angle = np.arccos(np.clip(sims[np.arange(len(ids)), cell], -1, 1))
            others = np.where(ids[:, None] == pivot_ids[None, :], -np.inf, sims)
            floor = np.sort(others, axis=1)[:, -k] if others.shape[1] >= k else np.full(len(ids), -1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("embedding"), pa.array(cell.astype(np.int32)), pa.array(angle),
                 pa.array(np.maximum(floor, -1.0))],
                names=["item_id", "embedding", "cell", "angle", "floor"],
            )

    return items.mapInArrow(assign, "item_id bigint, embedding array<float>, cell int, angle double, floor double")


def block_rows(total: int, rows_per_block: int, width: int) -> int:
    """Rows of a block: ``rows_per_block``, or more where that makes over ``MAX_BLOCKS`` blocks, up to ``VALUES_PER_BLOCK`` values."""
    return max(rows_per_block, min(math.ceil(total / MAX_BLOCKS), VALUES_PER_BLOCK // max(1, width)))


def all_pairs_top_k(
    items: DataFrame,
    k: int,
    rows_per_block: int = ROWS_PER_BLOCK,
    max_pivots: int = MAX_PIVOTS,
    seed: int = 42,
) -> DataFrame:
    """Exact ``k`` nearest neighbours of every item: ``id_a, id_b, similarity, rank``.

    Vectors are grouped around pivot items, about one for ``rows_per_block`` rows; large groups are cut into blocks and small ones share
    them.  There are about ``MAX_BLOCKS`` blocks until one holds ``VALUES_PER_BLOCK`` values, so up to there a row travels a fixed number of times.
    A first pass inside each block gives every row a similarity it must beat.  The triangle inequality of angles then tells
    which groups can still hold a better neighbour; a row is compared with the blocks of those groups only.  A task
    holds two blocks and emits ``k`` rows per row it answers.
    """
    spark = items.sparkSession
    vectors = _with_vector(items)
    total = vectors.count()
    n_pivots = max(1, min(max_pivots, total // rows_per_block))
    rows = collect_bounded(hash_sample(vectors, n_pivots, seed), n_pivots, "pivots")
    if not rows:
        return spark.createDataFrame([], "id_a bigint, id_b bigint, similarity double, rank int")
    pivots = normalized(np.array([r["embedding"] for r in rows], dtype=np.float64))
    pivot_ids = np.array([r["item_id"] for r in rows], dtype=np.int64)

    # The table is read by several jobs below, so it is written once.
    assigned = cut_lineage(_assign_cells(vectors, pivots, pivot_ids, k), "cells")
    cells = collect_bounded(
        assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")), n_pivots, "cells"
    )
    radius = np.full(n_pivots, -1.0)
    blocks, first_block = np.zeros(n_pivots, dtype=int), np.zeros(n_pivots, dtype=int)
    in_block = block_rows(total, rows_per_block, pivots.shape[1])
    made, room = 0, 0  # blocks so far, and rows that still fit into the last one
    for row in sorted(cells, key=lambda r: r["cell"]):
        cell, n = row["cell"], row["n"]
        radius[cell], blocks[cell] = row["radius"], math.ceil(n / in_block)
        if n <= room:
            first_block[cell], room = made - 1, room - n
        else:
            first_block[cell], room = made, in_block - n if n <= in_block else 0
            made += blocks[cell]
    starts, sizes = (F.array(*[F.lit(int(x)) for x in values]) for values in (first_block, blocks))
    part = F.pmod(F.xxhash64("item_id"), F.get(sizes, F.col("cell"))).cast("int")
    blocked = assigned.withColumn("block", F.get(starts, F.col("cell")) + part)

    def route(table: pa.Table) -> pa.Table:
        """Raise the bound of each row with its own block, then list the blocks that may hold a better row."""
        ids = table.column("item_id").to_numpy()
        unit = unit_rows(table.column("embedding"))
        bound = table.column("floor").to_numpy().copy()
        if len(ids) > k:
            for at in range(0, len(ids), QUERY_CHUNK):
                sims = unit[at : at + QUERY_CHUNK] @ unit.T
                sims[np.arange(len(sims)), at + np.arange(len(sims))] = -np.inf
                kth = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
                bound[at : at + QUERY_CHUNK] = np.maximum(bound[at : at + QUERY_CHUNK], kth)
        angles = np.arccos(np.clip(unit @ pivots.T, -1, 1))
        reachable = np.cos(np.maximum(angles - radius[None, :], 0)) + 1e-6 >= bound[:, None]
        reachable &= blocks[None, :] > 0
        visits = [
            sorted({int(first_block[c]) + i for c in np.flatnonzero(row) for i in range(blocks[c])}) for row in reachable
        ]
        return pa.table(
            {
                "item_id": table.column("item_id"),
                "embedding": table.column("embedding"),
                "block": table.column("block"),
                "visits": pa.array(visits, pa.list_(pa.int32())),
            }
        )

    routed = cut_lineage(
        blocked.select("item_id", "embedding", "floor", "block")
        .groupBy("block")
        .applyInArrow(route, "item_id bigint, embedding array<float>, block int, visits array<int>"),
        "routes",
    )
    asking = routed.select("item_id", "embedding", "block", F.explode("visits").alias("target"))
    meetings = asking.select("block", "target").distinct()
    holding = routed.select("item_id", "embedding", F.col("block").alias("target")).join(meetings, "target")
    result_schema = "id_a bigint, id_b bigint, similarity double"

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        left_ids, right_ids = left.column("item_id").to_numpy(), right.column("held_item_id").to_numpy()
        out_a, out_b, out_s = [], [], []
        if len(left_ids) and len(right_ids):
            unit_left, unit_right = unit_rows(left.column("embedding")), unit_rows(right.column("held_embedding"))
            for at in range(0, len(left_ids), QUERY_CHUNK):
                sims = np.round(unit_left[at : at + QUERY_CHUNK] @ unit_right.T, SIM_DECIMALS)
                asking_ids = left_ids[at : at + QUERY_CHUNK]
                rows, columns = best_per_row(sims, asking_ids, right_ids, k)
                out_a.append(asking_ids[rows])
                out_b.append(right_ids[columns])
                out_s.append(sims[rows, columns])
        empty = [np.empty(0)]
        return pa.table(
            {
                "id_a": pa.array(np.concatenate(out_a or empty).astype(np.int64)),
                "id_b": pa.array(np.concatenate(out_b or empty).astype(np.int64)),
                "similarity": pa.array(np.concatenate(out_s or empty).astype(np.float64)),
            }
        )

    left = asking.groupBy("block", "target")
    right = holding.select(*[F.col(c).alias(f"held_{c}") for c in holding.columns]).groupBy("held_block", "held_target")
    partial = left.cogroup(right).applyInArrow(compare, result_schema)
    return top_k_per_group(partial, ["id_a"], [F.col("similarity").desc(), F.col("id_b")], k, "id_b", salts=1)


# Genre coherence


def genre_similarities(items: DataFrame, genres: Sequence[str], n_samples: int = 100, seed: int = 42) -> DataFrame:
    """Mean and spread of similarities inside each genre and towards other genres, on samples per side.

    ``items`` has ``item_id, genre, embedding``.  The sample outside a genre is drawn from the samples of the other
    genres: its smallest hashed keys are among theirs.  A task gets at most two samples.
    """
    known = [F.lit(g) for g in genres]
    labelled = items.withColumn("side", F.when(F.col("genre").isin(list(genres)), F.col("genre")))
    labelled = labelled.where(F.col("embedding").isNotNull()).withColumn("side", F.coalesce("side", F.lit("")))
    drawn = hash_sample_per_group(labelled.select("item_id", "side", "embedding"), "side", n_samples, seed)
    pool = cut_lineage(drawn, "genre-samples")
    facing = pool.withColumn("genre", F.explode(F.array(*known))).withColumn("inside", F.col("side") == F.col("genre"))
    facing = facing.withColumn("part", F.concat_ws("\u0000", "genre", F.col("inside").cast("string")))
    sides = hash_sample_per_group(facing, "part", n_samples, seed).select("genre", "inside", "item_id", "embedding")

    def compare(table: pa.Table) -> pa.Table:
        inside = table.column("inside").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(table.column("item_id").to_numpy())
        unit = unit_rows(table.column("embedding"))[order]
        own, other = unit[inside[order]], unit[~inside[order]]
        rows = {"genre": [], "within_mean": [], "within_std": [], "across_mean": [], "across_std": []}
        if len(own) >= 2:
            within = (own @ own.T)[np.triu_indices(len(own), k=1)]
            across = (own @ other.T).ravel() if len(other) else np.array([np.nan])
            figures = [within.mean(), within.std(), across.mean(), across.std()]
            for name, value in zip(rows, [table.column("genre")[0].as_py(), *figures]):
                rows[name].append(value)
        return pa.table(rows, schema=pa.schema([("genre", pa.string())] + [(n, pa.float64()) for n in list(rows)[1:]]))

    schema = "genre string, within_mean double, within_std double, across_mean double, across_std double"
    compared = sides.groupBy("genre").applyInArrow(compare, schema)
    cleaned = compared.select("genre", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in compared.columns[1:]])
    return cleaned.withColumn("difference", F.col("within_mean") - F.col("across_mean")).orderBy(
        F.col("difference").desc_nulls_last(), "genre"
    )


def genre_overlap(recommended: DataFrame, resolved: DataFrame, catalog: DataFrame) -> DataFrame:
    """How many recommendations of each query share its first genre, in percent, with a coherence tier.

    ``recommended`` has ``query, genre``; ``resolved`` has ``query, item_id``.
    """
    asked = resolved.where(F.col("item_id").isNotNull())
    own = join_small(catalog.select("item_id", first_genre(F.col("genre")).alias("own_genre")), asked)
    (high, strong), (middle, moderate) = OVERLAP_TIERS
    counted = recommended.join(broadcast_if_small(own.select("query", "own_genre")), "query").groupBy("query").agg(
        F.count_if(first_genre(F.col("genre")) == F.col("own_genre")).alias("matches"),
        F.count(F.lit(1)).alias("recommendations"),
    )
    tier = F.when(F.col("matches") >= high, strong).when(F.col("matches") >= middle, moderate).otherwise("low")
    return counted.withColumn("percent", F.col("matches") * 100.0 / F.col("recommendations")).withColumn("tier", tier)


# Projection


def pca_projection(items: DataFrame, components: int = 2, column: str = "embedding") -> DataFrame:
    """Coordinates on the first principal components of the centred vectors: ``item_id, pc1, pc2, ...``."""
    assembled = items.where(F.col(column).isNotNull()).select("item_id", array_to_vector(column).alias("_v"))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(assembled).transform(assembled)
    projected = PCA(k=components, inputCol="_c", outputCol="_p").fit(centred).transform(centred)
    values = vector_to_array("_p")
    return projected.select("item_id", *[values[i].alias(f"pc{i + 1}") for i in range(components)])
