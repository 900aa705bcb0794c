import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.functions.vectors import cosine
from shelfrank.operators import similarity as V
from shelfrank.operators.embedding import TfIdfEmbedder, describe_query, embed
from shelfrank.operators.joins import align_embeddings, cluster_ids_of_titles, resolve_titles, title_suggestions
from shelfrank.sources import vectors as store


def table(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)], "item_id bigint, embedding array<float>")


def brute(matrix, k):
    m = np.asarray(matrix, dtype=np.float32).astype(float)
    n = np.linalg.norm(m, axis=1, keepdims=True)
    unit = np.divide(m, n, out=np.zeros_like(m), where=n > 0)
    sims = np.round(unit @ unit.T, V.SIM_DECIMALS)
    out = {}
    for i, row in enumerate(sims):
        order = sorted((j for j in range(len(m)) if j != i), key=lambda j: (-row[j], j))
        out[i] = order[:k]
    return out


SMALL = [[1, 0], [1, 0], [-1, 0], [0, 0], [1, 1], [1, -1]]


@pytest.fixture(scope="module")
def catalog(spark):
    names = ["Alpha", "Alpha", "Beta (one)", "Gamma+", "alphabet", None]
    return spark.createDataFrame([(i, n, float(i)) for i, n in enumerate(names)], "item_id bigint, names string, score double")


def test_nearest_excludes_the_item_but_not_its_copy(spark):
    found = V.nearest(table(spark, SMALL), [V.Query("q", [1, 0], 0)], 3).orderBy("rank").collect()
    assert [r["item_id"] for r in found] == [1, 4, 5]
    assert found[0]["similarity"] == 1.0


def test_free_vector_keeps_every_item(spark):
    found = V.nearest(table(spark, SMALL), [V.Query("q", [1, 0])], 6).orderBy("rank").collect()
    assert [r["item_id"] for r in found] == [0, 1, 4, 5, 3, 2]
    assert found[4]["similarity"] == 0.0 and found[5]["similarity"] == -1.0


def test_prefix_property(spark):
    rng = np.random.default_rng(2)
    items = table(spark, rng.normal(size=(300, 8))).repartition(5)
    query = [V.Query("q", rng.normal(size=8))]
    long = [r["item_id"] for r in V.nearest(items, query, 20).orderBy("rank").collect()]
    assert [r["item_id"] for r in V.nearest(items, query, 7).orderBy("rank").collect()] == long[:7]


def test_no_queries_give_an_empty_result(spark):
    assert V.nearest(table(spark, SMALL), [], 3).columns == ["query", "item_id", "similarity", "rank"]


def test_ragged_vectors_are_refused(spark):
    ragged = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "item_id bigint, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="same length"):
        V.nearest(ragged, [V.Query("q", [1.0, 0.0])], 1).collect()


@pytest.mark.parametrize("block, pivots", [(40, 8), (25, 1), (1000, 4)])
def test_all_pairs_equal_brute_force(spark, block, pivots):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6)) * 4
    matrix = centres[rng.choice(4, 150, p=[0.6, 0.2, 0.1, 0.1])] + rng.normal(size=(150, 6)) * 0.3
    matrix[10] = matrix[11] = matrix[12]
    matrix[20] = 0
    found = {}
    for row in V.all_pairs_top_k(table(spark, matrix), 5, rows_per_block=block, max_pivots=pivots).orderBy("rank").collect():
        found.setdefault(row["id_a"], []).append(row["id_b"])
    assert found == brute(matrix, 5)


def test_all_pairs_when_there_are_fewer_items_than_k(spark):
    rows = V.all_pairs_top_k(table(spark, [[1, 0], [0, 1], [1, 1]]), 10).collect()
    assert len(rows) == 6
    assert V.all_pairs_top_k(table(spark, []), 10).count() == 0


def test_titles(spark, catalog):
    asked = ["ALPHA", "alph", "beta (", "a+", "nothing"]
    out = {r["query"]: r["item_id"] for r in resolve_titles(catalog, asked).collect()}
    assert out == {"ALPHA": 0, "alph": 0, "beta (": 2, "a+": 3, "nothing": None}
    assert {r["query"]: r["item_id"] for r in resolve_titles(catalog, ["^alphab"], regex=True).collect()} == {"^alphab": 4}
    assert resolve_titles(catalog, []).count() == 0
    assert [r["item_id"] for r in title_suggestions(catalog, "alpha", 2).collect()] == [0, 1]
    last = {r["query"]: r["item_id"] for r in cluster_ids_of_titles(catalog, [" Alpha", "nothing"]).collect()}
    assert last == {" Alpha": 1}


def test_many_titles_are_looked_up_in_chunks(spark, catalog):
    asked = [f"no title {i}" for i in range(150)] + ["Gamma+"]
    rows = resolve_titles(catalog, asked).collect()
    assert len(rows) == 151 and [r["item_id"] for r in rows if r["query"] == "Gamma+"] == [3]


def test_similar_items_by_title(spark, catalog):
    out = V.similar_items(catalog, table(spark, SMALL), "alpha", 2).orderBy("rank").collect()
    assert [r["item_id"] for r in out] == [1, 4]
    assert V.similar_items(catalog, table(spark, SMALL), "nothing").count() == 0
    assert "similarity" not in V.similar_items(catalog, table(spark, SMALL), "alpha", with_scores=False).columns


def test_pair_similarity(spark, catalog):
    items = table(spark, SMALL)
    assert V.pair_similarity(catalog, items, "alpha", "beta").first()["similarity"] == -1.0
    assert V.pair_similarity(catalog, items, "alpha", "nothing").first()["similarity"] is None


def test_cosine_expression(spark):
    rows = [([1.0, 0.0], [2.0, 0.0]), ([0.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0]), ([1.0], [1.0, 2.0])]
    df = spark.createDataFrame(rows, "a array<float>, b array<float>")
    assert [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None, None]


def test_genre_similarities(spark):
    rng = np.random.default_rng(4)
    matrix = np.concatenate([rng.normal(size=(30, 4)) + 3, rng.normal(size=(30, 4)) - 3, rng.normal(size=(1, 4))])
    genres = ["a"] * 30 + ["b"] * 30 + ["c"]
    items = table(spark, matrix).join(spark.createDataFrame(list(enumerate(genres)), "item_id bigint, genre string"), "item_id")
    out = {r["genre"]: r for r in V.genre_similarities(items, ["a", "b", "c"], 100).collect()}
    assert set(out) == {"a", "b"}
    unit = V.normalized(matrix.astype(np.float32).astype(float))
    within = (unit[:30] @ unit[:30].T)[np.triu_indices(30, k=1)]
    across = (unit[:30] @ unit[30:].T).ravel()
    assert out["a"]["within_mean"] == pytest.approx(within.mean()) and out["a"]["within_std"] == pytest.approx(within.std())
    assert out["a"]["across_mean"] == pytest.approx(across.mean()) and out["a"]["across_std"] == pytest.approx(across.std())


def test_layouts_and_storage(spark, tmp_path):
    items = table(spark, np.arange(24).reshape(2, 12))
    wide = store.array_to_wide(items, 12)
    assert store.wide_columns(wide)[9:11] == ["embed_9", "embed_10"]
    assert store.wide_to_array(wide).orderBy("item_id").collect() == items.orderBy("item_id").collect()
    wide.write.parquet(str(tmp_path / "wide"))
    assert store.load_embeddings(spark, str(tmp_path / "wide")).orderBy("item_id").collect() == items.orderBy("item_id").collect()
    with pytest.raises(ValueError, match="unsupported"):
        store.save_embeddings(items, str(tmp_path / "x"), "npy")
    with pytest.raises(ValueError, match="needs item_id"):
        store.save_embeddings(items.drop("item_id"), str(tmp_path / "x"))
    with pytest.raises(ValueError, match="unsupported"):
        store.load_embeddings(spark, str(tmp_path / "x"), "npz")


def test_alignment(spark, catalog):
    items = table(spark, SMALL[:4])
    with pytest.raises(ValueError, match="no embedding"):
        align_embeddings(catalog, items)
    assert align_embeddings(catalog, items, strict=False).count() == 4


def test_pca_matches_svd(spark):
    rng = np.random.default_rng(6)
    matrix = rng.normal(size=(60, 5)) * [5, 3, 1, 1, 1] + 10
    rows = V.pca_projection(table(spark, matrix)).orderBy("item_id").collect()
    found = np.array([[r["pc1"], r["pc2"]] for r in rows])
    m = matrix.astype(np.float32).astype(float)
    u, s, _ = np.linalg.svd(m - m.mean(axis=0), full_matrices=False)
    np.testing.assert_allclose(np.abs(found), np.abs(u[:, :2] * s[:2]), atol=1e-6)


def test_embedders(spark, tmp_path):
    texts = spark.createDataFrame([(1, "red cat"), (2, "red dog"), (3, "blue sky"), (4, None)], "item_id bigint, names string")
    with pytest.raises(ValueError, match="fit"):
        TfIdfEmbedder().transform(texts, "names")
    embedder = TfIdfEmbedder(32).fit(texts, "names")
    items = embedder.transform(texts, "names").select("item_id", "embedding")
    assert {len(r["embedding"]) for r in items.collect()} == {32}
    best = describe_query(texts, items, "red cat", embedder, 2).orderBy("rank").collect()
    assert best[0]["item_id"] == 1 and best[0]["similarity"] == pytest.approx(1, abs=1e-6)
    loaded = TfIdfEmbedder.load(embedder.save(str(tmp_path / "model")))
    assert loaded.dimension == 32 and loaded.encode_single(spark, "red cat") == embedder.encode_single(spark, "red cat")

    def load():
        return lambda batch: np.array([[len(t), 1.0] for t in batch])

    lengths = {r["item_id"]: list(r["embedding"]) for r in embed(texts, "names", load, batch=2).collect()}
    assert lengths == {1: [7.0, 1.0], 2: [7.0, 1.0], 3: [8.0, 1.0], 4: [0.0, 1.0]}


def test_blocks_of_pairs_do_not_grow_in_number_with_the_rows(spark):
    assert [-(-n // V.block_rows(n, 4096, 64)) for n in (5_000, 100_000, 600_000, 1_000_000)] == [2, 25, 32, 32]
    assert V.block_rows(100_000_000, 4096, 64) == 1 << 15
    r = random.Random(4)
    matrix = [[r.gauss(0, 1) for _ in range(4)] for _ in range(400)]
    found = V.all_pairs_top_k(table(spark, matrix), 3, rows_per_block=2, max_pivots=100).collect()
    unit = V.normalized(np.array(matrix, dtype=np.float32).astype(float))
    sims = unit @ unit.T - 3 * np.eye(400)
    best = {(r["id_a"], r["rank"]): r["similarity"] for r in found}
    assert len(best) == 1200
    for i, row in enumerate(-np.sort(-sims, axis=1)[:, :3]):
        assert [best[i, k + 1] for k in range(3)] == pytest.approx(row.tolist(), abs=1e-8)
