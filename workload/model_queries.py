"""Quality models over the catalog."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfrank.operators import features as E
from shelfrank.operators import fold_stats as L
from shelfrank.operators import forest as T
from shelfrank.operators import quality as Q
from shelfrank.operators import stats as S
from shelfrank.scale import cut_lineage, shared_folder
from workload.registry import AS_OF_YEAR, CLEAN_SQL, SEED, clean, query, round_columns, rounded, row_bound
from workload.vector_queries import HYBRID_TITLES, recommender

SPLIT_SQL = f"""numbered AS (SELECT *, row_number() OVER (ORDER BY substr(md5(item_id || '-{SEED}'), 1, 15), item_id) AS rn, count(*) OVER () AS n FROM clean),
  parts AS (SELECT *, CASE WHEN rn <= n - 2 * ceil(n * 0.15) THEN 'train' WHEN rn <= n - ceil(n * 0.15) THEN 'val' ELSE 'test' END AS "set" FROM numbered)"""


def fitted(spark, sf):
    """The cleaned catalog, its feature matrix, and the state that was built with.  Both are read many times, so they are written once."""
    cleaned = clean(spark, sf, often=True)
    state = E.fit_features(cleaned, AS_OF_YEAR, row_bound=row_bound(spark, sf))
    return cleaned, cut_lineage(E.feature_matrix(cleaned, state), "feature-matrix"), state


def matrix(spark, sf):
    """Feature matrix and the state it was built with."""
    _, data, state = fitted(spark, sf)
    return data, state


def predictions(spark, sf):
    """Rows with a label, a fixed prediction and their split."""
    labelled = clean(spark, sf, "score", "quality_fixed").select(
        "item_id", F.col("score").alias("label"), F.col("quality_fixed").alias("prediction")
    )
    return Q.split_sets(labelled)


@query("scaled_features", CLEAN_SQL + "SELECT item_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in ("score", "budget_x", "revenue")) + " FROM clean")
def scaled_features(spark, sf):
    columns = ["score", "budget_x", "revenue"]
    return Q.standardize(clean(spark, sf, *columns), columns).transform(round_columns, *columns)


@query("split_sets", CLEAN_SQL + f', {SPLIT_SQL} SELECT item_id, "set" FROM parts')
def split_sets(spark, sf):
    return Q.split_sets(clean(spark, sf, "score")).select("item_id", "set")


@query("metrics_by_set", CLEAN_SQL + f""", {SPLIT_SQL}, m AS (SELECT "set", avg(score) AS mean FROM parts GROUP BY "set")
  SELECT "set", count(*) AS rows, round(sqrt(avg(pow(score - quality_fixed, 2))), 6) AS rmse, round(avg(abs(score - quality_fixed)), 6) AS mae,
    round(1 - sum(pow(score - quality_fixed, 2)) / sum(pow(score - mean, 2)), 6) AS r2 FROM parts JOIN m USING ("set") GROUP BY "set\"""")
def metrics_by_set(spark, sf):
    return Q.metrics_by_set(predictions(spark, sf)).transform(round_columns, "rmse", "mae", "r2")


@query("within_tolerance", CLEAN_SQL + f""", {SPLIT_SQL}
  SELECT "set", round(avg(CASE WHEN abs(score - quality_fixed) <= 5 THEN 1.0 ELSE 0.0 END) * 100, 6) AS within_5,
    round(avg(CASE WHEN abs(score - quality_fixed) <= 10 THEN 1.0 ELSE 0.0 END) * 100, 6) AS within_10 FROM parts GROUP BY "set\"""")
def within_tolerance(spark, sf):
    return Q.within_tolerance(predictions(spark, sf)).transform(round_columns, "within_5", "within_10")


@query("residuals", CLEAN_SQL + f', {SPLIT_SQL} SELECT item_id, "set", score AS label, quality_fixed AS prediction, score - quality_fixed AS residual FROM parts')
def residuals(spark, sf):
    return Q.residuals(predictions(spark, sf)).select("item_id", "set", "label", "prediction", "residual")


@query("best_model", CLEAN_SQL + """ SELECT country, round(avg(quality_fixed), 6) AS mean_value FROM clean GROUP BY country ORDER BY avg(quality_fixed) DESC, country LIMIT 1""")
def best_model(spark, sf):
    return S.arg_max_group(clean(spark, sf, "country", "quality_fixed"), "country", "quality_fixed").transform(round_columns, "mean_value")


def one_feature_fit(spark, sf, kind):
    data = clean(spark, sf, "score", "budget_x").select((F.col("budget_x") / 1000).alias("x"), F.col("score").alias("label"))
    assembled = VectorAssembler(inputCols=["x"], outputCol="features").transform(data)
    fitted = Q.make_regressor(kind).fit(assembled)
    rows = [("slope", float(fitted.coefficients[0])), ("intercept", float(fitted.intercept))]
    return spark.createDataFrame(rows, "term string, value double").select("term", rounded("value"))


@query("linear_fit", CLEAN_SQL + """ SELECT unnest(['slope', 'intercept']) AS term,
  unnest([round(regr_slope(score, budget_x / 1000), 6), round(regr_intercept(score, budget_x / 1000), 6)]) AS value FROM clean""")
def linear_fit(spark, sf):
    return one_feature_fit(spark, sf, "linear")


@query("ridge_fit", CLEAN_SQL + """, f AS (SELECT regr_sxy(score, budget_x / 1000) / (regr_sxx(score, budget_x / 1000) + 1) AS b, avg(score) AS my, avg(budget_x / 1000) AS mx FROM clean)
  SELECT unnest(['slope', 'intercept']) AS term, unnest([round(b, 6), round(my - b * mx, 6)]) AS value FROM f""")
def ridge_fit(spark, sf):
    return one_feature_fit(spark, sf, "ridge")


@query("linear_evaluation")
def linear_evaluation(spark, sf):
    _, report = Q.train_and_evaluate(*matrix(spark, sf), "linear")
    return report.transform(round_columns, "rmse", "mae", "r2")


@query("forest_fit")
def forest_fit(spark, sf):
    _, report = Q.train_and_evaluate(*matrix(spark, sf), "random_forest")
    return report.transform(round_columns, "rmse", "mae", "r2")


@query("compare_models")
def compare_models(spark, sf):
    best, table = Q.compare_models(*matrix(spark, sf))
    return table.withColumn("best", F.col("model") == best).transform(round_columns, "rmse", "mae", "r2")


@query("importance_topn")
def importance_topn(spark, sf):
    return Q.train(*matrix(spark, sf), "random_forest").importances(20)


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    data, state = matrix(spark, sf)
    model = Q.train(data, state, "ridge")
    stored = Q.QualityModel.load(spark, model.save(shared_folder(spark, "model")))
    before, after = model.predict(data, output="before"), stored.predict(data, output="after")
    return before.select("item_id", "before").join(after.select("item_id", "after"), "item_id")


@query("grid_search")
def grid_search(spark, sf):
    model = Q.grid_search(*matrix(spark, sf), "ridge")
    rows = [(k, float(v)) for k, v in {**model.metrics, **model.best_params}.items()]
    return spark.createDataFrame(rows, "metric string, value double")


@query("forest_grid_search")
def forest_grid_search(spark, sf):
    """All 81 settings in five folds."""
    data, state = matrix(spark, sf)
    _, found = T.search_forest(data, state.columns)
    return spark.createDataFrame([(k, float(v)) for k, v in found.items()], "metric string, value double")


@query("split_forest")
def split_forest(spark, sf):
    """The forest with a minimum of rows to split, fitted on the training part; metrics of every part."""
    data, state = matrix(spark, sf)
    parts = Q.split_sets(data.where(F.col("label").isNotNull()))
    grown = T.fit_forest(parts.where(F.col("set") == "train"), state.columns)
    return Q.metrics_by_set(parts.join(grown.predict(parts), "item_id")).transform(round_columns, "rmse", "mae", "r2")


@query("forest_importances")
def forest_importances(spark, sf):
    data, state = matrix(spark, sf)
    return T.fit_forest(data, state.columns).importances()


LEVEL_COLUMNS = ("budget_x", "revenue")


def _levels_sql(depth: int, min_split: int) -> str:
    """The tree's nodes down to ``depth``: each level tries every column and value, and moves the rows on."""
    numbered = ", ".join(f"({i}, {c})" for i, c in enumerate(LEVEL_COLUMNS))
    edges = "edges AS (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS next FROM (SELECT DISTINCT f, x FROM long0))"
    parts = ["at0 AS (SELECT item_id, CAST(1 AS BIGINT) AS node, score AS y, budget_x, revenue FROM clean)"]
    for i in range(depth):
        parts.append(f"""long{i} AS (SELECT node, y, f, x FROM at{i}, LATERAL (VALUES {numbered}) AS v(f, x)),
  steps{i} AS (SELECT node, f, x, sum(count(*)) OVER w AS ln, sum(sum(y)) OVER w AS ls, lead(x) OVER w AS following,
    sum(count(*)) OVER (PARTITION BY node, f) AS n, sum(sum(y)) OVER (PARTITION BY node, f) AS s
    FROM long{i} GROUP BY node, f, x WINDOW w AS (PARTITION BY node, f ORDER BY x)),
  best{i} AS (SELECT node, f, x, following, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) AS gain FROM steps{i} WHERE following IS NOT NULL AND n >= {min_split}
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x) = 1),
  at{i + 1} AS (SELECT a.item_id, 2 * a.node + CASE WHEN CASE WHEN f = 0 THEN budget_x ELSE revenue END > b.x THEN 1 ELSE 0 END AS node, y, budget_x, revenue
    FROM at{i} a JOIN best{i} b ON b.node = a.node)""")
    parts.append(edges)
    splits = " UNION ALL ".join(f"SELECT node, f, (x + next) / 2 AS threshold FROM best{i} JOIN edges USING (f, x)" for i in range(depth))
    nodes = " UNION ALL ".join(f"SELECT node, count(*) AS rows, sum(y) / count(*) AS value FROM at{i} GROUP BY node" for i in range(depth + 1))
    return f"""{CLEAN_SQL}, {", ".join(parts)}
  SELECT n.node, n.rows, round(n.value, 6) AS value, CASE s.f WHEN 0 THEN 'budget_x' WHEN 1 THEN 'revenue' END AS feature, round(s.threshold, 6) AS threshold
  FROM ({nodes}) n LEFT JOIN ({splits}) s USING (node)"""


@query("forest_levels", _levels_sql(3, 10))
def forest_levels(spark, sf):
    """Three levels of one tree over all rows, every value of a column a possible cut."""
    data = clean(spark, sf, "score", *LEVEL_COLUMNS).withColumnRenamed("score", "label")
    grown = T.exact_tree(data, LEVEL_COLUMNS, depth=3, min_split=10)
    return grown.select("node", "rows", rounded("value"), "feature", rounded("threshold"))


FOLDS_SQL = f"""folded AS (SELECT budget_x / 1000 AS x, score AS y, CAST('0x' || substr(md5(item_id || '-{SEED}'), 1, 15) AS BIGINT) % 5 AS fold FROM clean),
  fits AS (SELECT f AS fold, count(*) AS n, regr_slope(y, x) AS b, avg(x) AS mx, avg(y) AS my FROM folded JOIN range(5) r(f) ON fold <> f GROUP BY f),
  lines AS (SELECT fold, 'linear' AS model, b, my - b * mx AS a FROM fits UNION ALL SELECT fold, 'ridge', b * n / (n + 1), my - b * n / (n + 1) * mx FROM fits),
  sides AS (SELECT l.fold, model, CASE WHEN d.fold = l.fold THEN 'test' ELSE 'train' END AS "set", y, y - a - b * x AS e FROM lines l, folded d)"""


@query("fold_report", CLEAN_SQL + f""", {FOLDS_SQL}
  SELECT model, CAST(fold AS INTEGER) AS fold, "set", round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2, round(sqrt(avg(e * e)), 6) AS rmse
  FROM sides GROUP BY ALL""")
def fold_report(spark, sf):
    """Both linear kinds on one feature in five folds."""
    data = clean(spark, sf, "score", "budget_x").select("item_id", F.col("score").alias("label"), (F.col("budget_x") / 1000).alias("x"))
    triangles = L.part_triangles(data, ["x"], "label", [Q.fold_of("item_id", 5), F.lit(0)])
    fits = [(kind, fold, side, r2, rmse) for kind, _, fold, side, _, r2, rmse in L.fold_fits(triangles, 5, L.LINEAR_KINDS)]
    return spark.createDataFrame(fits, "model string, fold int, set string, r2 double, rmse double").transform(round_columns, "r2", "rmse")


@query("cv_report")
def cv_report(spark, sf):
    return Q.cv_report(*matrix(spark, sf), ("linear", "ridge", "random_forest"))


@query("learning_curve")
def learning_curve(spark, sf):
    data, state = matrix(spark, sf)
    curves = [Q.learning_curve(data, state, kind).withColumn("model", F.lit(kind)) for kind in ("linear", "ridge", "random_forest")]
    return curves[0].unionByName(curves[1]).unionByName(curves[2])


@query("quality_scores")
def quality_scores(spark, sf):
    items, data, state = fitted(spark, sf)
    return Q.train(data, state, "ridge").score_items(items).transform(round_columns, "quality_score_pred")


@query("hybrid_end_to_end")
def hybrid_end_to_end(spark, sf):
    items, data, state = fitted(spark, sf)
    return recommender(spark, sf, Q.train(data, state, "ridge").score_items, items).recommend(HYBRID_TITLES)


@query("least_squares_check", CLEAN_SQL + " SELECT count(*) AS rows, CAST(0 AS DOUBLE) AS worst_product FROM clean")
def least_squares_check(spark, sf):
    """At the least-squares solution the residuals have no product with any scaled feature; the largest mean product, in size."""
    data, state = matrix(spark, sf)
    model = Q.train(data, state, "linear").pipeline
    fitted = model.transform(data).select(vector_to_array("features").alias("x"), (F.col("label") - F.col("prediction")).alias("e"))
    products = fitted.select(F.posexplode("x").alias("feature", "value"), "e").groupBy("feature").agg(
        F.count(F.lit(1)).alias("rows"), F.abs(F.avg(F.col("value") * F.col("e"))).alias("product")
    )
    return products.agg(F.max("rows").alias("rows"), rounded(F.max("product"), alias="worst_product"))


@query("model_roundtrip_check", CLEAN_SQL + " SELECT count(*) AS rows, CAST(0 AS BIGINT) AS differing FROM clean")
def model_roundtrip_check(spark, sf):
    both = model_roundtrip(spark, sf)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("before").eqNullSafe(F.col("after"))).alias("differing"))


@query("quality_range_check", CLEAN_SQL + " SELECT item_id, true AS in_range FROM clean")
def quality_range_check(spark, sf):
    return quality_scores(spark, sf).select("item_id", F.col("quality_score_pred").between(0, 100).alias("in_range"))


@query("forest_range_check", CLEAN_SQL + f""", {SPLIT_SQL}
  SELECT "set", count(*) AS rows, CAST(0 AS BIGINT) AS outside FROM parts GROUP BY "set\"""")
def forest_range_check(spark, sf):
    """A forest's predictions are means of labels, so none lies outside their range."""
    data, state = matrix(spark, sf)
    parts = Q.split_sets(data)
    training = parts.where(F.col("set") == "train")
    low, high = training.agg(F.min("label"), F.max("label")).first()
    predicted = parts.join(T.fit_forest(training, state.columns).predict(parts), "item_id")
    outside = ~F.col("prediction").between(low - 1e-9, high + 1e-9)
    return predicted.groupBy("set").agg(F.count(F.lit(1)).alias("rows"), F.count_if(outside).alias("outside"))
