import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfrank.operators import clusters as K
from shelfrank.operators import quality as Q
from shelfrank.operators.features import FeatureState
from shelfrank.plans.hybrid import HybridRecommender, score_breakdown

STATE = FeatureState(2025, {}, [])


def assignments(spark):
    rows = [(1, 0, [0.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 0, [4.0, 0.0]), (4, 1, [9.0, 9.0]), (5, 2, [5.0, 5.0])]
    return spark.createDataFrame(rows, "item_id bigint, cluster_id int, features array<double>")


def scores(spark, ids):
    assigned = assignments(spark)
    refs = spark.createDataFrame([(i,) for i in ids], "item_id bigint")
    return {r["item_id"]: r["cluster_score"] for r in K.cluster_scores(assigned, K.mean_centroids(assigned), refs).collect()}


def test_cluster_scores(spark):
    assert scores(spark, [1]) == {1: 0.0, 2: 100.0, 3: 0.0, 4: 0.0, 5: 0.0}
    assert scores(spark, [1, 1, 4, 77])[2] == pytest.approx(100 * 2 / 3)
    assert scores(spark, [77]) == scores(spark, []) == dict.fromkeys(range(1, 6), 0.0)


def test_a_single_member_sits_on_its_centroid(spark):
    assigned = assignments(spark).unionByName(assignments(spark).where("item_id = 4").withColumn("item_id", F.lit(6).cast("bigint")))
    refs = spark.createDataFrame([(4,)], "item_id bigint")
    out = {r["item_id"]: r["cluster_score"] for r in K.cluster_scores(assigned, K.mean_centroids(assigned), refs).collect()}
    assert out[6] == 100.0 and out[4] == 0.0


def test_cluster_report(spark):
    assigned = assignments(spark)
    refs = spark.createDataFrame([(1,)], "item_id bigint")
    catalog = spark.createDataFrame([(i, f"n{i}", 1.0) for i in range(1, 6)], "item_id bigint, names string, score double")
    found = K.cluster_report(K.cluster_scores(assigned, K.mean_centroids(assigned), refs), catalog, refs, 2).collect()
    assert {(r["role"], r["item_id"]) for r in found} == {("reference", 1), ("recommended", 2), ("recommended", 3)}


def brute_silhouette(x, labels):
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    values = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            values.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        values.append((b - a) / max(a, b))
    return np.mean(values)


@pytest.mark.parametrize("block", [7, 1000])
def test_euclidean_silhouette(spark, block):
    rng = np.random.default_rng(1)
    x, labels = rng.normal(size=(40, 3)), np.array([0] * 20 + [1] * 19 + [2])
    x[labels == 1] += 2
    rows = [(i, int(c), [float(v) for v in p]) for i, (c, p) in enumerate(zip(labels, x))]
    df = spark.createDataFrame(rows, "item_id bigint, cluster_id int, features array<double>")
    assert K.euclidean_silhouette(df, block).first()[0] == pytest.approx(brute_silhouette(x, labels))


def test_kmeans(spark, tmp_path):
    with pytest.raises(ValueError):
        K.ItemClusterer().assignments
    with pytest.raises(ValueError):
        K.ItemClusterer().centroids
    rows = [(i, float(i % 2) * 100 + i / 100, 1.0, None if i == 7 else 2.0) for i in range(40)]
    df = spark.createDataFrame(rows, "item_id bigint, a double, b double, c double")
    for scale in (False, True):
        fitted = K.ItemClusterer(["a", "b", "c"], clusters=2, scale=scale).fit(df)
        found = fitted.assignments.collect()
        assert len(found) == 39 and len({(r["item_id"] % 2, r["cluster_id"]) for r in found}) == 2
        assert K.silhouette(fitted.assignments) > 0.9
    assert K.wide_centroids(fitted.centroids, ["a", "b", "c"]).columns == ["cluster_id", "a", "b", "c"]
    loaded = K.ItemClusterer.load(fitted.save(str(tmp_path / "k")))
    assert loaded.scale and loaded.features == ["a", "b", "c"]
    assert sorted(map(str, loaded.assign(df).select("item_id", "cluster_id").collect())) == sorted(
        map(str, fitted.assignments.select("item_id", "cluster_id").collect())
    )
    sweep = K.kmeans_sweep(df, (2, 3), features=["a", "b", "c"]).collect()
    assert [r["k"] for r in sweep] == [2, 3]


def regression(spark, n=60, d=3):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, d)) * [1, 5, 0.2]
    y = x @ [2.0, -1.0, 4.0] + 7 + rng.normal(size=n)
    rows = [(i, *map(float, p), float(t)) for i, (p, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "item_id bigint, x0 double, x1 double, x2 double, label double"), x, y


@pytest.mark.parametrize("alpha", [0.0, 1.0, 25.0])
def test_ridge_matches_closed_form(spark, alpha):
    df, x, y = regression(spark)
    data = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(df)
    model = Q.make_regressor("ridge", alpha=alpha).fit(data)
    centred = x - x.mean(axis=0)
    weights = np.linalg.solve(centred.T @ centred + alpha * np.eye(3), centred.T @ (y - y.mean()))
    np.testing.assert_allclose(model.coefficients.toArray(), weights, rtol=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ weights)


def test_linear_tolerates_constant_and_repeated_columns(spark):
    df, x, y = regression(spark)
    wide = df.withColumns({"x3": F.lit(1.0), "x4": F.col("x0")})
    state = FeatureState(2025, {}, [])
    stages = Q.scaling_stages(["x0", "x1", "x2", "x3", "x4"], 60)
    from pyspark.ml import Pipeline

    fitted = Pipeline(stages=[*stages, Q.make_regressor("linear")]).fit(wide)
    model = Q.QualityModel("linear", fitted, state)
    found = np.array([r["prediction"] for r in model.predict(wide, clipped=False).orderBy("item_id").collect()])
    design = np.column_stack([np.ones(60), x])
    np.testing.assert_allclose(found, design @ np.linalg.lstsq(design, y, rcond=None)[0], atol=1e-3)


@pytest.mark.parametrize("kind", ["linear", "ridge"])
def test_the_real_matrix_is_solved_exactly(spark, kind):
    from workload.model_queries import matrix

    data, state = matrix(spark, "/root/testdata/sf0.01")
    model = Q.train(data, state, kind)
    table = model.pipeline.transform(data.where("label IS NOT NULL")).toPandas()
    x, y = np.stack([v.toArray() for v in table.features]), table.label.to_numpy()
    xc, yc = x - x.mean(axis=0), y - y.mean()
    if kind == "ridge":
        weights = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
        np.testing.assert_allclose(model.pipeline.stages[-1].coefficients.toArray(), weights, rtol=1e-8, atol=1e-10)
    else:
        weights = np.linalg.lstsq(xc, yc, rcond=None)[0]
    squared = np.sum((yc - xc @ weights) ** 2)
    assert np.sum((y - table.prediction) ** 2) == pytest.approx(squared, rel=1e-8)


def test_population_scaling(spark):
    df, x, _ = regression(spark)
    wide = df.withColumn("x3", F.lit(4.0))
    scaler = Q.FeatureScaler(["x0", "x1", "x2", "x3"])
    with pytest.raises(ValueError, match="not fitted"):
        scaler.transform(wide)
    rows = scaler.fit(wide).transform(wide).orderBy("item_id").collect()
    expected = np.column_stack([(x - x.mean(axis=0)) / x.std(axis=0), np.zeros(60)])
    np.testing.assert_allclose(np.array([r["features"].toArray() for r in rows]), expected, atol=1e-9)
    native = Q.standardize(wide, ["x0", "x3"]).orderBy("item_id").collect()
    np.testing.assert_allclose([[r["x0"], r["x3"]] for r in native], expected[:, [0, 3]], atol=1e-9)


def test_unknown_model_type():
    with pytest.raises(ValueError, match="unknown model type"):
        Q.make_regressor("boosting")


def test_metrics(spark):
    rows = [("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 5.0), ("b", 5.0, 4.0)]
    df = spark.createDataFrame(rows, "set string, label double, prediction double")
    out = {r["set"]: r for r in Q.metrics_by_set(df).collect()}
    assert out["a"]["rmse"] == pytest.approx(0.5**0.5) and out["a"]["mae"] == 0.5 and out["a"]["r2"] == pytest.approx(0.5)
    assert out["b"]["r2"] is None
    shares = {r["set"]: r["within_0.5"] for r in Q.within_tolerance(df, [0.5]).collect()}
    assert shares == {"a": 50.0, "b": 50.0}


def matrix(spark):
    df, _, _ = regression(spark, 120)
    state = FeatureState(2025, {}, [])
    return df, state


@pytest.fixture
def narrow(monkeypatch):
    monkeypatch.setattr(FeatureState, "columns", property(lambda self: ["x0", "x1", "x2"]))


def test_training_tuning_and_storage(spark, tmp_path, narrow):
    data, state = matrix(spark)
    for scale_on in ("train", "all"):
        model, report = Q.train_and_evaluate(data, state, "linear", scale_on=scale_on)
        assert {r["set"] for r in report.collect()} == {"train", "val", "test"} and model.metrics["test_r2"] > 0.8
    with pytest.raises(ValueError, match="scale_on"):
        Q.train_and_evaluate(data, state, "linear", scale_on="test")
    assert model.importances() is None and model.info().first()["has_feature_importance"] is False
    tuned = Q.grid_search(data, state, "ridge", folds=3, grid={"alpha": (0.1, 1000.0)})
    assert tuned.best_params == {"alpha": 0.1} and "cv_score" in tuned.metrics and tuned.metrics["r2"] > 0.8
    assert Q.grid_search(data, state, "linear").best_params == {}
    stored = Q.QualityModel.load(spark, tuned.save(str(tmp_path / "m")))
    assert stored.best_params == tuned.best_params and stored.metrics == tuned.metrics
    before = [r["prediction"] for r in tuned.predict(data).orderBy("item_id").collect()]
    assert [r["prediction"] for r in stored.predict(data).orderBy("item_id").collect()] == before
    assert all(0 <= p <= 100 for p in before)
    forest = Q.train(data, state, "random_forest", numTrees=5, maxDepth=3)
    assert [r["feature"] for r in forest.importances(1).collect()] == ["x1"]


def test_comparison_and_validation(spark, narrow):
    data, state = matrix(spark)
    best, table = Q.compare_models(data, state, ("linear", "random_forest"), random_forest={"numTrees": 3, "maxDepth": 2})
    assert best == "linear" and table.count() == 6
    report = Q.cv_report(data, state, ["linear"], folds=3)
    assert report.count() == 6 and Q.cv_summary(report).count() == 2
    curve = Q.learning_curve(data, state, "linear", fractions=(0.5, 1.0), folds=2)
    assert {(r["fraction"], r["set"]) for r in curve.collect()} == {(0.5, "train"), (0.5, "test"), (1.0, "train"), (1.0, "test")}


def hybrid(spark, with_clusters=True):
    names = ["Ref", "near", "far", "other", "near"]
    catalog = spark.createDataFrame([(i, n, 2000) for i, n in enumerate(names)], "item_id bigint, names string, year int")
    vectors = [[1.0, 0.0], [0.9, 0.1], [-1.0, 0.0], [0.0, 1.0], [0.95, 0.0]]
    items = spark.createDataFrame(list(enumerate(vectors)), "item_id bigint, embedding array<float>")
    quality = lambda rows: rows.select("item_id", F.lit(50.0).alias("quality_score_pred"))
    if not with_clusters:
        return HybridRecommender(catalog, items, quality)
    assigned = items.select("item_id", F.when(F.col("item_id") < 3, 0).otherwise(1).alias("cluster_id"), F.col("embedding").alias("features"))
    return HybridRecommender(catalog, items, quality, assigned, K.mean_centroids(assigned))


def test_hybrid_ranking(spark):
    found = hybrid(spark).recommend(["ref"]).collect()
    assert [r["item_id"] for r in found][0] == 4
    assert 0 not in {r["item_id"] for r in found}
    assert [r["final_score"] for r in found] == sorted((r["final_score"] for r in found), reverse=True)
    parts = score_breakdown(hybrid(spark).recommend(["ref"])).collect()
    assert all(r["final_score"] == pytest.approx(r["similarity_part"] + r["quality_part"] + r["cluster_part"]) for r in parts)
    keep = {r["item_id"] for r in hybrid(spark).recommend(["ref"], dedupe=False).collect()}
    assert {1, 4} <= keep


def test_hybrid_without_clusters_or_title(spark):
    found = hybrid(spark, with_clusters=False).recommend(["ref"], n=2, weights={"similarity": 1.0, "quality": 0.0, "cluster": 0.0})
    assert [r["cluster_score"] for r in found.collect()] == [0.0, 0.0]
    empty = hybrid(spark).recommend(["no such title"])
    assert empty.count() == 0 and empty.columns[:3] == ["item_id", "names", "year"]
    with pytest.raises(ValueError, match="required"):
        HybridRecommender(None, None, None)
