"""Similarity, clusters and hybrid ranking over the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfrank.functions import text as X
from shelfrank.operators import clusters as K
from shelfrank.operators import ranking as R
from shelfrank.operators import similarity as V
from shelfrank.operators import stats as S
from shelfrank.operators.embedding import TfIdfEmbedder, describe_query
from shelfrank.operators.joins import align_embeddings, resolve_titles
from shelfrank.plans import hybrid as H
from shelfrank.plans.semantic_index import build_index
from shelfrank.scale import shared_folder
from shelfrank.sources import vectors as store
from workload.catalog_queries import documents, sql_draw, sql_resolve
from workload.registry import CLEAN_SQL, CLEAN_VEC_SQL, SEED, VEC_SQL, clean, query, round_columns, rounded, vectors

QUERY_TITLES = ["red widget", "BLUE", "cold plate"]
DIMENSION = 64

NEAREST_SQL = """sims AS (
  SELECT q.query, v.item_id, round(list_cosine_similarity(own.v, v.v), 9) AS similarity
  FROM q JOIN vec own ON own.item_id = q.item_id JOIN vec v ON v.item_id <> q.item_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY similarity DESC, item_id) AS INTEGER) AS rank FROM sims)"""


def sql_titles(titles) -> str:
    return f"q AS ({sql_resolve(titles)})"


# Layouts and statistics


@query("embedding_roundtrip", VEC_SQL + " SELECT item_id, label, CAST(len(v) AS INTEGER) AS dimension, round(list_sum(v), 5) AS total FROM vec")
def embedding_roundtrip(spark, sf):
    path = store.save_embeddings(vectors(spark, sf), shared_folder(spark, "embeddings"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return store.load_embeddings(spark, path).select(
        "item_id", "label", F.size("embedding").alias("dimension"), rounded(total, 5, "total")
    )


@query("array_to_wide", VEC_SQL + f" SELECT item_id, {', '.join(f'CAST(v[{i + 1}] AS FLOAT) AS embed_{i}' for i in range(8))} FROM vec")
def array_to_wide(spark, sf):
    wide = store.array_to_wide(vectors(spark, sf), DIMENSION)
    return wide.select("item_id", *store.wide_columns(wide)[:8])


@query("wide_to_array", VEC_SQL + " SELECT item_id, CAST(len(v) AS INTEGER) AS dimension, v[1] AS first, v[64] AS last FROM vec")
def wide_to_array(spark, sf):
    again = store.wide_to_array(store.array_to_wide(vectors(spark, sf), DIMENSION))
    return again.select(
        "item_id",
        F.size("embedding").alias("dimension"),
        F.col("embedding")[0].cast("double").alias("first"),
        F.col("embedding")[DIMENSION - 1].cast("double").alias("last"),
    )


@query("embedding_stats", VEC_SQL + """, x AS (SELECT unnest(v) AS x FROM vec)
  SELECT (SELECT count(*) FROM vec) AS count, (SELECT CAST(max(len(v)) AS INTEGER) FROM vec) AS dimension, round(avg(x), 6) AS mean,
    round(stddev_pop(x), 6) AS std, min(x) AS min, max(x) AS max FROM x""")
def embedding_stats(spark, sf):
    return S.embedding_stats(vectors(spark, sf)).transform(round_columns, "mean", "std")


@query("per_dim_stats", VEC_SQL + """, x AS (SELECT unnest(v) AS x, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS dimension FROM vec)
  SELECT dimension, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM x GROUP BY dimension""")
def per_dim_stats(spark, sf):
    return S.per_dimension_stats(vectors(spark, sf)).transform(round_columns, "mean", "std")


@query("value_histogram", VEC_SQL + """, x AS (SELECT unnest(v) AS x FROM vec), span AS (SELECT min(x) AS lo, (max(x) - min(x)) / 100 AS w FROM x)
  SELECT CAST(least(floor((x - lo) / w), 99) AS INTEGER) AS bin, round(any_value(lo + least(floor((x - lo) / w), 99) * w), 6) AS bin_start, count(*) AS count FROM x, span GROUP BY 1""")
def value_histogram(spark, sf):
    return S.histogram(vectors(spark, sf), F.explode("embedding"), 100).transform(round_columns, "bin_start")


# Similarity


@query("similar_items", CLEAN_VEC_SQL + f""", {sql_titles(['red widget'])}, {NEAREST_SQL}
  SELECT query, ranked.item_id, similarity, rank, names, score, year, genre, overview FROM ranked JOIN clean USING (item_id) WHERE rank <= 10""")
def similar_items(spark, sf):
    return V.similar_items(clean(spark, sf, "names", "score", "year", "genre", "overview"), vectors(spark, sf), "red widget")


@query("batch_similar", CLEAN_VEC_SQL + f""", {sql_titles(QUERY_TITLES)}, {NEAREST_SQL}
  SELECT query, ranked.item_id, similarity, rank, names FROM ranked JOIN clean USING (item_id) WHERE rank <= 20""")
def batch_similar(spark, sf):
    return V.batch_similar(clean(spark, sf, "names"), vectors(spark, sf), QUERY_TITLES, 20)


@query("pair_similarity", CLEAN_VEC_SQL + f""", {sql_titles(['red widget', 'BLUE'])}
  SELECT 'red widget' AS title_a, 'BLUE' AS title_b, round(list_cosine_similarity(a.v, b.v), 9) AS similarity
  FROM vec a, vec b WHERE a.item_id = (SELECT item_id FROM q WHERE position = 0) AND b.item_id = (SELECT item_id FROM q WHERE position = 1)""")
def pair_similarity(spark, sf):
    return V.pair_similarity(clean(spark, sf, "names"), vectors(spark, sf), "red widget", "BLUE")


@query("pair_matrix", CLEAN_VEC_SQL + """, top AS (SELECT item_id, v FROM clean JOIN vec USING (item_id) ORDER BY score DESC, item_id LIMIT 20)
  SELECT a.item_id AS id_a, b.item_id AS id_b, round(list_cosine_similarity(a.v, b.v), 9) AS similarity FROM top a, top b""")
def pair_matrix(spark, sf):
    return V.pair_matrix(clean(spark, sf, "score"), vectors(spark, sf))


@query("vector_query_topk", VEC_SQL + """, mean AS (
  SELECT list(m ORDER BY i) AS c FROM (SELECT i, avg(x) AS m FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM vec) GROUP BY i))
  SELECT item_id, round(list_cosine_similarity(v, c), 9) AS similarity, CAST(row_number() OVER (ORDER BY round(list_cosine_similarity(v, c), 9) DESC, item_id) AS INTEGER) AS rank
  FROM vec, mean ORDER BY rank LIMIT 15""")
def vector_query_topk(spark, sf):
    """Items closest to the mean vector; the query is no item, so nothing is skipped."""
    items = vectors(spark, sf)
    means = S.per_dimension_stats(items).orderBy("dimension").limit(DIMENSION).collect()
    ranked = V.nearest(items, [V.Query("mean", [r["mean"] for r in means])], 15)
    return ranked.select("item_id", "similarity", "rank")


@query("all_pairs_topk", VEC_SQL + """, sims AS (SELECT a.item_id AS id_a, b.item_id AS id_b, round(list_cosine_similarity(a.v, b.v), 9) AS similarity FROM vec a JOIN vec b ON a.item_id <> b.item_id),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY id_a ORDER BY similarity DESC, id_b) AS INTEGER) AS rank FROM sims)
  SELECT id_a, id_b, similarity, rank FROM ranked WHERE rank <= 10""")
def all_pairs_topk(spark, sf):
    return V.all_pairs_top_k(vectors(spark, sf), 10)


@query("random_pair_similarity", VEC_SQL + f""", indexed AS (SELECT item_id, v, row_number() OVER (ORDER BY item_id) - 1 AS i FROM vec),
  drawn AS (SELECT pair_id, {sql_draw('a', SEED)} % (SELECT count(*) FROM vec) AS a, {sql_draw('b', SEED)} % (SELECT count(*) FROM vec) AS b FROM range(10000) t(pair_id))
  SELECT pair_id, x.item_id AS id_a, y.item_id AS id_b, round(list_cosine_similarity(x.v, y.v), 9) AS similarity FROM drawn JOIN indexed x ON x.i = a JOIN indexed y ON y.i = b""")
def random_pair_similarity(spark, sf):
    return V.random_pair_similarity(vectors(spark, sf), 10_000, SEED)


@query("similarity_distribution", VEC_SQL + f""", indexed AS (SELECT item_id, v, row_number() OVER (ORDER BY item_id) - 1 AS i FROM vec),
  drawn AS (SELECT pair_id, {sql_draw('a', SEED)} % (SELECT count(*) FROM vec) AS a, {sql_draw('b', SEED)} % (SELECT count(*) FROM vec) AS b FROM range(10000) t(pair_id)),
  sims AS (SELECT round(list_cosine_similarity(x.v, y.v), 9) AS s FROM drawn JOIN indexed x ON x.i = a JOIN indexed y ON y.i = b)
  SELECT round(avg(s), 6) AS mean, round(quantile_cont(s, 0.5), 6) AS median, round(stddev_pop(s), 6) AS std, min(s) AS min, max(s) AS max FROM sims""")
def similarity_distribution(spark, sf):
    pairs = V.random_pair_similarity(vectors(spark, sf), 10_000, SEED)
    return S.similarity_summary(pairs, row_bound=10_000).transform(round_columns, "mean", "median", "std")


@query("within_across_similarity", VEC_SQL + f""", h AS (SELECT item_id, v, CAST(label AS VARCHAR) AS genre, substr(md5(item_id || '-{SEED}'), 1, 15) AS h FROM vec),
  g AS (SELECT genre FROM (SELECT genre, count(*) AS n FROM h GROUP BY genre) ORDER BY n DESC, genre LIMIT 8),
  inside AS (SELECT g.genre, item_id, v, row_number() OVER (PARTITION BY g.genre ORDER BY h, item_id) AS r FROM g JOIN h ON g.genre = h.genre),
  outside AS (SELECT g.genre, item_id, v, row_number() OVER (PARTITION BY g.genre ORDER BY h, item_id) AS r FROM g JOIN h ON g.genre <> h.genre),
  w AS (SELECT a.genre, list_cosine_similarity(a.v, b.v) AS s FROM inside a JOIN inside b ON a.genre = b.genre AND a.item_id < b.item_id WHERE a.r <= 100 AND b.r <= 100),
  x AS (SELECT a.genre, list_cosine_similarity(a.v, b.v) AS s FROM inside a JOIN outside b ON a.genre = b.genre WHERE a.r <= 100 AND b.r <= 100),
  ws AS (SELECT genre, avg(s) AS m, stddev_pop(s) AS d FROM w GROUP BY genre), xs AS (SELECT genre, avg(s) AS m, stddev_pop(s) AS d FROM x GROUP BY genre)
  SELECT genre, round(ws.m, 6) AS within_mean, round(ws.d, 6) AS within_std, round(xs.m, 6) AS across_mean, round(xs.d, 6) AS across_std, round(ws.m - xs.m, 6) AS difference
  FROM ws JOIN xs USING (genre)""")
def within_across_similarity(spark, sf):
    items = vectors(spark, sf).withColumn("genre", F.col("label").cast("string"))
    genres = S.collect_top(S.value_counts(items, "genre", "genre"), "genre", 8)
    compared = V.genre_similarities(items.select("item_id", "genre", "embedding"), genres, 100, SEED)
    return round_columns(compared, "within_mean", "within_std", "across_mean", "across_std", "difference")


@query("genre_overlap", CLEAN_VEC_SQL + f""", {sql_titles(QUERY_TITLES)}, {NEAREST_SQL},
  matched AS (SELECT ranked.query, count(*) AS recommendations, count(*) FILTER (trim(split_part(r.genre, ',', 1)) = trim(split_part(o.genre, ',', 1))) AS matches
    FROM ranked JOIN clean r ON r.item_id = ranked.item_id JOIN q ON q.query = ranked.query JOIN clean o ON o.item_id = q.item_id WHERE rank <= 10 GROUP BY ranked.query)
  SELECT query, matches, recommendations, round(matches * 100.0 / recommendations, 6) AS percent, CASE WHEN matches >= 7 THEN 'strong' WHEN matches >= 4 THEN 'moderate' ELSE 'low' END AS tier FROM matched""")
def genre_overlap(spark, sf):
    catalog = clean(spark, sf, "names", "genre")
    resolved = resolve_titles(catalog, QUERY_TITLES)
    recommended = V.batch_similar(catalog, vectors(spark, sf), QUERY_TITLES)
    return V.genre_overlap(recommended, resolved, catalog).transform(round_columns, "percent")


@query("franchise_rank", CLEAN_VEC_SQL + f""", {sql_titles(QUERY_TITLES)}, {NEAREST_SQL},
  hit AS (SELECT query, rank, names, similarity, row_number() OVER (PARTITION BY query ORDER BY rank) AS n FROM ranked JOIN clean USING (item_id) WHERE rank <= 10 AND contains(lower(names), 'ring'))
  SELECT query, rank, names, similarity, CASE WHEN similarity > 0.8 THEN 'excellent' WHEN similarity > 0.7 THEN 'good' ELSE 'moderate' END AS tier FROM hit WHERE n = 1""")
def franchise_rank(spark, sf):
    recommended = V.batch_similar(clean(spark, sf, "names"), vectors(spark, sf), QUERY_TITLES)
    return R.rank_of_matches(recommended, "ring")


@query("aligned_items", CLEAN_VEC_SQL + " SELECT item_id, names, CAST(len(v) AS INTEGER) AS dimension FROM clean JOIN vec USING (item_id)")
def aligned_items(spark, sf):
    aligned = align_embeddings(clean(spark, sf, "names"), vectors(spark, sf), strict=False)
    return aligned.select("item_id", "names", F.size("embedding").alias("dimension"))


@query("embed_text")
def embed_text(spark, sf):
    texts = documents(spark, sf).select("item_id", X.clean_text(F.col("text")).alias("text"))
    return TfIdfEmbedder().fit(texts, "text").transform(texts, "text").select("item_id", F.size("embedding").alias("dimension"), rounded(F.array_max("embedding"), alias="largest"))


@query("semantic_index")
def semantic_index(spark, sf):
    index, _ = build_index(clean(spark, sf, "names", "overview", "genre", "score", "year"), shared_folder(spark, "index"))
    return index.select("item_id", "names", "overview_processed", F.size("embedding").alias("dimension"))


@query("describe_query")
def describe(spark, sf):
    texts = documents(spark, sf).select("item_id", X.clean_text(F.col("text")).alias("text"))
    embedder = TfIdfEmbedder().fit(texts, "text")
    found = describe_query(texts, embedder.transform(texts, "text"), "the story of a journey and its end", embedder)
    return found.select("query", "item_id", "rank", rounded("similarity"))


@query("pca_2d")
def pca_2d(spark, sf):
    return V.pca_projection(vectors(spark, sf)).transform(round_columns, "pc1", "pc2")


# Clusters

CENTROIDS_SQL = """grouped AS (SELECT item_id, label AS cluster_id, v FROM vec),
  centroids AS (SELECT cluster_id, list(m ORDER BY i) AS c FROM (
    SELECT cluster_id, i, avg(x) AS m FROM (SELECT cluster_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM grouped) GROUP BY cluster_id, i) GROUP BY cluster_id)"""
SCORES_SQL = """weights AS (SELECT cluster_id, count(*) / sum(count(*)) OVER () AS w FROM refs JOIN grouped USING (item_id) GROUP BY cluster_id),
  dist AS (SELECT item_id, cluster_id, w, list_distance(v, c) AS d FROM grouped JOIN centroids USING (cluster_id) LEFT JOIN weights USING (cluster_id)),
  scores AS (SELECT item_id, cluster_id, CASE WHEN item_id IN (SELECT item_id FROM refs) THEN 0.0
    ELSE coalesce(CASE WHEN max(d) OVER (PARTITION BY cluster_id) = 0 THEN 1 ELSE 1 - d / max(d) OVER (PARTITION BY cluster_id) END * w * 100, 0.0) END AS cluster_score FROM dist)"""
REFERENCES = (3, 7, 7, 21, 987654321)


def labelled(spark, sf):
    return vectors(spark, sf).select("item_id", F.col("label").alias("cluster_id"), F.col("embedding").alias("features"))


def references(spark):
    return spark.createDataFrame([(i,) for i in REFERENCES], "item_id bigint")


REFS_SQL = f"refs AS (SELECT unnest([{', '.join(map(str, REFERENCES))}]) AS item_id)"


@query("cluster_scores", VEC_SQL + f", {CENTROIDS_SQL}, {REFS_SQL}, {SCORES_SQL} SELECT item_id, cluster_id, round(cluster_score, 6) AS cluster_score FROM scores")
def cluster_scores(spark, sf):
    assigned = labelled(spark, sf)
    return K.cluster_scores(assigned, K.mean_centroids(assigned), references(spark)).transform(round_columns, "cluster_score")


@query("cluster_sizes", "SELECT label AS cluster_id, count(*) AS count FROM embeddings GROUP BY label")
def cluster_sizes(spark, sf):
    return K.cluster_sizes(labelled(spark, sf))


@query("cluster_report", CLEAN_VEC_SQL + f""", {CENTROIDS_SQL}, {REFS_SQL}, {SCORES_SQL},
  listed AS (SELECT *, 'reference' AS role FROM scores WHERE item_id IN (SELECT item_id FROM refs)
    UNION ALL (SELECT *, 'recommended' FROM scores WHERE item_id NOT IN (SELECT item_id FROM refs) ORDER BY round(cluster_score, 9) DESC, item_id LIMIT 10))
  SELECT item_id, role, cluster_id, round(cluster_score, 9) AS cluster_score, names, year, score, budget_x, revenue FROM listed LEFT JOIN clean USING (item_id)""")
def cluster_report(spark, sf):
    assigned = labelled(spark, sf)
    scores = K.cluster_scores(assigned, K.mean_centroids(assigned), references(spark))
    catalog = clean(spark, sf, "names", "year", "score", "budget_x", "revenue")
    return K.cluster_report(scores.transform(round_columns, "cluster_score", digits=9), catalog, references(spark))


@query("centroids", VEC_SQL + f", {CENTROIDS_SQL} SELECT cluster_id, unnest([0, 1, 2, 63]) AS position, round(unnest([c[1], c[2], c[3], c[64]]), 6) AS value FROM centroids")
def centroids(spark, sf):
    means = K.mean_centroids(labelled(spark, sf))
    picked = F.array(*[F.struct(F.lit(i).alias("position"), rounded(F.col("centroid")[i], 6, "value")) for i in (0, 1, 2, 63)])
    return means.select("cluster_id", F.inline(picked))


@query("euclidean_silhouette", VEC_SQL + """, sizes AS (SELECT label, count(*) AS n FROM vec GROUP BY label),
  d AS (SELECT a.item_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS s FROM vec a, vec b GROUP BY 1, 2, 3),
  ab AS (SELECT item_id, max(CASE WHEN own = other THEN n END) AS n, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS a,
    min(CASE WHEN own <> other THEN s / n END) AS b FROM d JOIN sizes ON sizes.label = d.other GROUP BY item_id)
  SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END), 6) AS silhouette FROM ab""")
def euclidean_silhouette(spark, sf):
    return K.euclidean_silhouette(labelled(spark, sf)).transform(round_columns, "silhouette")


@query("squared_silhouette", VEC_SQL + """, sizes AS (SELECT label, count(*) AS n FROM vec GROUP BY label),
  d AS (SELECT a.item_id, a.label AS own, b.label AS other, sum(pow(list_distance(a.v, b.v), 2)) AS s FROM vec a, vec b GROUP BY 1, 2, 3),
  ab AS (SELECT item_id, max(CASE WHEN own = other THEN n END) AS n, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS a,
    min(CASE WHEN own <> other THEN s / n END) AS b FROM d JOIN sizes ON sizes.label = d.other GROUP BY item_id)
  SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END), 6) AS silhouette FROM ab""")
def squared_silhouette(spark, sf):
    value = K.silhouette(labelled(spark, sf))
    return spark.createDataFrame([(value,)], "silhouette double").transform(round_columns, "silhouette")


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    """Every item; one with a missing feature has no cluster."""
    clusterer = K.ItemClusterer().fit(clean(spark, sf, "year", "score", "budget_x", "revenue", often=True))
    unplaced = clusterer.unplaced.select("item_id", F.lit(None).cast("int").alias("cluster_id"))
    return clusterer.assignments.select("item_id", "cluster_id").unionByName(unplaced)


@query("kmeans_check", CLEAN_SQL + """ SELECT count(*) AS items, count(*) FILTER (year IS NULL OR budget_x IS NULL OR revenue IS NULL) AS unplaced,
  CAST(0 AS BIGINT) AS misplaced FROM clean""")
def kmeans_check(spark, sf):
    """Items, those with a missing feature, and those that some other centroid is nearer to than their own."""
    clusterer = K.ItemClusterer(max_iter=20).fit(clean(spark, sf, "year", "score", "budget_x", "revenue", often=True))
    centers = F.broadcast(clusterer.centroids.agg(F.collect_list(F.struct("cluster_id", "centroid")).alias("all")))  # one row of k centroids
    squared = lambda c: F.aggregate(F.zip_with("features", c["centroid"], lambda x, m: (x - m) * (x - m)), F.lit(0.0), lambda t, d: t + d)
    placed = clusterer.assignments.select("item_id", "cluster_id", "features").withColumn("k", F.lit(1)).join(centers.withColumn("k", F.lit(1)), "k")
    distances = F.transform("all", lambda c: F.struct(squared(c).alias("d"), c["cluster_id"].alias("c")))
    nearest = F.array_min(F.transform(distances, lambda x: x["d"]))
    own = F.filter(distances, lambda x: x["c"] == F.col("cluster_id"))[0]["d"]
    counted = placed.agg(F.count(F.lit(1)).alias("n"), F.count_if(own > nearest * (1 + 1e-9)).alias("misplaced")).first()
    missing = clusterer.unplaced.count()
    return spark.createDataFrame([(counted["n"] + missing, missing, counted["misplaced"])], "items long, unplaced long, misplaced long")


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    data = clean(spark, sf, "year", "score", "budget_x", "revenue", often=True).persist()
    sweep = K.kmeans_sweep(data, max_iter=50)
    data.unpersist()
    return sweep


# Hybrid

HYBRID_TITLES = ["red widget", "cold plate"]
HYBRID_SQL = CLEAN_VEC_SQL + f""", {CENTROIDS_SQL}, {sql_titles(HYBRID_TITLES)}, {NEAREST_SQL},
  refs AS (SELECT max(clean.item_id) AS item_id FROM clean JOIN q ON trim(lower(names)) = trim(lower(query)) GROUP BY query), {SCORES_SQL},
  sem AS (SELECT item_id, similarity * 100 AS sim_score_norm FROM (
    SELECT item_id, similarity, row_number() OVER (PARTITION BY names ORDER BY similarity DESC, item_id) AS n FROM ranked JOIN clean USING (item_id) WHERE rank <= 50) WHERE n = 1),
  clu AS (SELECT item_id FROM scores WHERE cluster_score > 0.1 ORDER BY cluster_score DESC, item_id LIMIT 50),
  pool AS (SELECT item_id FROM sem UNION SELECT item_id FROM clu EXCEPT SELECT item_id FROM q),
  last AS (SELECT trim(lower(names)) AS k, arg_max(cluster_score, item_id) AS cluster_score FROM clean JOIN scores USING (item_id) GROUP BY 1),
  rated AS (SELECT item_id, names, year, coalesce(sim_score_norm, 0) AS sim_score_norm, quality_fixed AS quality_score_pred, coalesce(last.cluster_score, 0) AS cluster_score
    FROM pool JOIN clean USING (item_id) LEFT JOIN sem USING (item_id) LEFT JOIN last ON k = trim(lower(names))),
  final AS (SELECT *, 0.6 * sim_score_norm + 0.2 * quality_score_pred + 0.2 * cluster_score AS final_score FROM rated)"""


def recommender(spark, sf, quality=None, catalog=None):
    catalog = catalog or clean(spark, sf, "names", "year", "quality_fixed")
    fixed = lambda items: items.select("item_id", F.col("quality_fixed").alias("quality_score_pred"))
    assigned = labelled(spark, sf)
    return H.HybridRecommender(catalog, vectors(spark, sf), quality or fixed, assigned, K.mean_centroids(assigned))


@query("hybrid_recommend", HYBRID_SQL + """ SELECT item_id, names, year, round(final_score, 9) AS final_score, round(sim_score_norm, 9) AS sim_score_norm,
  quality_score_pred, round(cluster_score, 9) AS cluster_score FROM final ORDER BY round(final_score, 9) DESC, item_id LIMIT 10""")
def hybrid_recommend(spark, sf):
    return round_columns(recommender(spark, sf).recommend(HYBRID_TITLES), "final_score", "sim_score_norm", "cluster_score", digits=9)


@query("score_breakdown", HYBRID_SQL + """ SELECT item_id, names, round(final_score, 9) AS final_score, round(sim_score_norm * 0.6, 9) AS similarity_part,
  round(quality_score_pred * 0.2, 9) AS quality_part, round(cluster_score * 0.2, 9) AS cluster_part FROM final ORDER BY round(final_score, 9) DESC, item_id LIMIT 5""")
def score_breakdown(spark, sf):
    ranked = recommender(spark, sf).recommend(HYBRID_TITLES)
    return round_columns(H.score_breakdown(ranked), "final_score", "similarity_part", "quality_part", "cluster_part", digits=9)
