import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank.operators import features as E
from shelfrank.operators import ranking as R
from shelfrank.operators import stats as S


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        (1, "a", 10.0, 2000, 0.0, "X, Y", "en"), (2, "a", 20.0, 2001, 5.0, "Y", "en"), (3, None, None, None, 7.0, None, "fr"),
        (4, None, 40.0, 2001, None, "X Men", "en"), (5, "b", 100.0, 1999, 9.0, "Z", None),
    ]
    return spark.createDataFrame(rows, "item_id bigint, names string, score double, year int, budget_x double, genre string, orig_lang string")


def test_duplicates_ignore_missing_titles(frame):
    assert S.duplicate_titles(frame).first().asDict() == {"duplicate_titles": 1, "duplicate_title_rows": 2}


def test_duplicate_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "a int, b string")
    assert S.duplicate_rows(df).first()[0] == 2


def test_null_report(frame):
    out = [(r["column"], r["nulls"]) for r in S.missing_report(frame).collect()]
    assert out == [("names", 2), ("budget_x", 1), ("genre", 1), ("orig_lang", 1), ("score", 1), ("year", 1)]


def test_genre_mean_by_substring(frame):
    out = {r["genre"]: (r["mean_score"], r["above_mean"]) for r in S.genre_mean_scores(frame, ["x", "Y", "q.z"]).collect()}
    assert out == {"x": (25.0, 0), "Y": (15.0, 0)}
    by_pattern = S.genre_mean_scores(frame, ["^[xz]"], regex=True).first()
    assert by_pattern["mean_score"] == 50.0 and by_pattern["above_mean"] == 1


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    counts = {r["bin"]: r["count"] for r in S.histogram(df, "x", 5).collect()}
    expected, _ = np.histogram(np.arange(11.0), 5)
    assert [counts[i] for i in range(5)] == expected.tolist()
    constant = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [r["count"] for r in S.histogram(constant, "x", 2).collect()] == [2]


def test_boxplot(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    box = S.boxplot_stats(df, "x").first()
    assert (box["q1"], box["median"], box["q3"]) == (2.0, 3.0, 4.0)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 4.0, 1)
    assert [r["x"] for r in S.boxplot_outliers(df, "x").collect()] == [100.0]


def test_density_integrates_to_one(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(v),) for v in rng.normal(size=500)], "x double")
    rows = sorted(S.density(df, "x", 200).collect(), key=lambda r: r["point"])
    step = rows[1]["position"] - rows[0]["position"]
    assert sum(r["density"] for r in rows) * step == pytest.approx(1, abs=1e-3)
    with pytest.raises(ValueError):
        S.density(df.where("x > 1000"), "x")


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 0.0), (None, 1.0, 5.0)], "a double, b double, c double")
    out = {(r["column_a"], r["column_b"]): r["correlation"] for r in S.correlation(df, ["a", "b", "c"]).collect()}
    assert out[("a", "b")] == out[("b", "a")] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1])
    assert out[("a", "a")] == pytest.approx(1)
    assert len(S.correlation(df, ["a", "b", "c"], upper_only=True).collect()) == 3


def test_report_sections(frame):
    sections = {r["section"] for r in S.stats_report(frame.withColumn("revenue", F.lit(1.0))).collect()}
    assert {"basic", "duplicates", "nulls", "quality", "nulls_per_column", "top_genre", "distinct_orig_lang"} <= sections


def test_temporal_features_fill_after_the_recency_flag(frame):
    out = {r["item_id"]: r for r in E.temporal_features(frame, 2005).collect()}
    assert out[3]["is_recent"] == 0 and out[3]["release_year"] == 2000.5 and out[3]["movie_age"] == 4.5
    assert out[1]["is_recent"] == 1


def test_vocabulary_and_encoding(frame):
    genres = E.fit_genres(frame, 2)
    assert genres == ["Y", "Unknown"]
    out = {r["item_id"]: r for r in E.encode_genres(frame, genres).collect()}
    assert out[1]["genre_y"] == 1 and out[3]["genre_unknown"] == 1 and out[1]["genre_count"] == 2


def test_feature_matrix_has_each_column_once(frame):
    full = frame.withColumns({"revenue": F.lit(3.0), "overview": F.lit("some words"), "crew": F.lit("a,b"), "country": F.lit("US")})
    state = E.fit_features(full, 2025)
    matrix = E.feature_matrix(full, state)
    assert len(state.columns) == len(set(state.columns)) == len(E.FEATURES) + len(state.genres)
    assert matrix.where(" or ".join(f"{c} is null" for c in state.columns)).count() == 0
    scored = E.refit_matrix(full.limit(1), state.columns, 2025)
    assert scored.columns == ["item_id", *state.columns]


def test_best_per_title_and_ranks(spark):
    rows = [(1, "t", 0.5), (2, "t", 0.9), (3, "t", 0.9), (4, "u", None)]
    df = spark.createDataFrame(rows, "item_id bigint, names string, similarity double")
    assert {(r["names"], r["item_id"]) for r in R.best_per_title(df, "similarity").collect()} == {("t", 2), ("u", 4)}
    ranked = spark.createDataFrame([("q", 1, "Toy Two", 0.85), ("q", 2, "Toy Three", 0.75), ("r", 1, "None", 0.1)], "query string, rank int, names string, similarity double")
    hit = R.rank_of_matches(ranked, "three").first()
    assert (hit["query"], hit["rank"], hit["tier"]) == ("q", 2, "good")
