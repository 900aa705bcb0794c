import datetime

import pytest
from pyspark.sql import functions as F

from shelfrank.functions import numbers as N
from shelfrank.functions import text as X
from shelfrank.operators import cleaning as C
from shelfrank.operators import projections as P
from shelfrank.operators.text_prep import combined_text, preprocess_descriptions


def evaluate(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["out"] for r in rows.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


TEXTS = [
    ("See https://a.b/c?d=1 and www.x.org now", "see and now"),
    ("Mail me@x.org or @home or a@@b.c!", "mail or home or"),
    ("Don't stop: 42 times", "don't stop times"),
    ("Ém il\tand\nline\r\nbreak", "m il and line break"),
    ("  many   spaces  ", "many spaces"),
    ("x y\x1cz", "x y z"),
    ("", ""),
    (None, ""),
    ("12345 !!!", ""),
]


def test_clean_text(spark):
    assert evaluate(spark, [t for t, _ in TEXTS], X.clean_text) == [e for _, e in TEXTS]


def test_clean_text_is_idempotent_on_plain_text(spark):
    once = evaluate(spark, [t for t, _ in TEXTS], X.clean_text)
    assert evaluate(spark, once, X.clean_text) == once


def test_clean_text_on_a_very_long_word(spark):
    assert evaluate(spark, ["a" * 200_000 + "@"], X.clean_text) == ["a" * 200_000]


GENRES = [
    ("Action, Science Fiction ,Drama", ["Action", "Science Fiction", "Drama"]),
    ("[{'id': 18, 'name': 'Drama'}, {'id': 2, 'name': ' War '}]", ["Drama", "War"]),
    ("[{'id': None, 'name': 'Drama'}]", ["Drama"]),
    ("[{'id': 1, 'name': \"Kids' TV\"}, {'id': 2}]", ["Kids' TV"]),
    ("[{'name': 'None: a True story', 'adult': False, 'id': None}]", ["None: a True story"]),
    ("[1, 2]", []),
    ("[broken", ["[broken"]),
    ("1917", ["1917"]),
    ("[]", []),
    ("Unknown", []),
    ("A,,Unknown", ["A"]),
    ("", []),
    (None, []),
]


def test_genre_names(spark):
    assert evaluate(spark, [g for g, _ in GENRES], X.genre_names) == [e for _, e in GENRES]


def test_genre_text(spark):
    assert evaluate(spark, ["Science Fiction, Drama", None], X.genre_text) == ["science_fiction drama", ""]


def test_genre_list_and_first_genre(spark):
    values = [" A , B", None, "Unknown"]
    assert evaluate(spark, values, X.genre_list) == [["A", "B"], ["Unknown"], ["Unknown"]]
    assert evaluate(spark, values, X.first_genre) == ["A", "Unknown", "Unknown"]
    assert evaluate(spark, [*values, ""], X.has_genre) == [True, False, False, False]


def test_counts(spark):
    values = ["a b c\n d", "", None, "x"]
    assert evaluate(spark, values, X.word_count) == [4, 0, 0, 1]
    assert evaluate(spark, ["a,b", "", None], X.comma_count) == [2, 1, 1]


def test_title_search_is_literal_unless_asked(spark):
    values = ["What (is) this+", "Other", None]
    assert evaluate(spark, values, lambda c: X.title_contains(c, "(IS)")) == [True, False, None]
    assert evaluate(spark, values, lambda c: X.title_contains(c, "^o.*r$", regex=True)) == [False, True, None]


def test_combined_text(spark):
    rows = [
        (1, "Toy Story", "Animation, Science Fiction", "Led by Woody, toys live."),
        (2, "!!!", None, "A long enough text"),
        (3, "Up", "Unknown", "hi"),
    ]
    df = spark.createDataFrame(rows, "item_id int, names string, genre string, overview string")
    out = {r["item_id"]: r for r in combined_text(df).collect()}
    assert out[1]["overview_processed"] == "toy story animation science_fiction led by woody toys live"
    assert out[2]["overview_processed"] == "a long enough text"
    assert set(out) == {1, 2}
    plain = combined_text(df, include_title=False, include_genres=False, min_length=1)
    assert {r["overview_processed"] for r in plain.collect()} == {"led by woody toys live", "a long enough text", "hi"}


def test_minimum_length_is_inclusive(spark):
    df = spark.createDataFrame([("abcdefghi",), ("abcdefghij",)], "t string")
    assert [r["t"] for r in preprocess_descriptions(df, "t").collect()] == ["abcdefghij"]


def test_score_bands_are_right_closed(spark):
    labels = evaluate(spark, [0.0, 0.1, 40.0, 40.1, 60.0, 80.0, 100.0, 100.1, None], N.score_band, "double")
    assert labels == [
        None, "Low (0-40)", "Low (0-40)", "Medium (40-60)", "Medium (40-60)", "Good (60-80)", "Excellent (80-100)", None, None,
    ]


def test_numbers_from_text(spark):
    values = ["1,000", "1.5d", " 12 ", "1e3", "-.5", "inf", "NaN", "x", None]
    assert evaluate(spark, values, N.to_number) == [None, None, 12.0, 1000.0, -0.5, None, None, None, None]


def test_numeric_helpers(spark):
    assert evaluate(spark, [float("nan"), float("inf"), 1.0, None], N.finite, "double") == [None, None, 1.0, None]
    assert evaluate(spark, [-3.0, 50.0, 120.0, None], N.clip, "double") == [0.0, 50.0, 100.0, None]
    assert evaluate(spark, [1995, 2000, None], N.decade, "int") == [1990, 2000, None]
    roi = evaluate(spark, [0.0, 50.0], lambda c: N.return_on_investment(F.lit(100.0), c), "double")
    assert roi == [None, 100.0]


def test_dates(spark):
    df = spark.createDataFrame([("3/2/2023",), (" 03/02/2023 ",), ("13/01/2020",), ("n/a",), (None,)], "date_x string")
    parsed = [r["date_x"] for r in C.parse_date(df).collect()]
    assert parsed == [datetime.date(2023, 3, 2), datetime.date(2023, 3, 2), None, None, None]


def test_clean_catalog_order_of_steps(spark):
    rows = [
        ("a", "1/2/2020", "50", "G", None, None, None, "fr", "X", "10", None, "FR"),
        ("b", "bad", "oops", None, "t", "c", None, "en", None, None, "4", None),
        ("c", "5/6/2021", None, "G", "t", "c", None, "en", "X", "99", "99", "US"),
        ("d", "5/6/2021", "70", "G", "t", "c", None, "en", "X", "30", "8", "US"),
    ]
    from shelfrank.sources.files import RAW_SCHEMA

    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    out = {r["names"]: r for r in C.clean_catalog(raw).collect()}
    assert set(out) == {"a", "b", "d"}
    assert out["b"]["score"] is None and out["b"]["year"] is None
    assert out["b"]["budget_x"] == 20.0 and out["a"]["revenue"] == 6.0
    assert out["b"]["genre"] == "Unknown" and out["a"]["overview"] == "Unknown"
    assert "date_x" not in C.clean_catalog(raw).columns and "status" not in C.clean_catalog(raw).columns
    assert {r["names"] for r in C.clean_catalog(raw, drop_uncoercible=True).collect()} == {"a", "d"}


def test_projections(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    assert P.available_columns(df, ["c", "zz", "a"]).columns == ["c", "a"]
    assert P.numeric_columns(df) == ["a", "b"]
    assert P.align_columns(df, ["b", "new"], keep=["a"]).first().asDict() == {"a": 1, "b": 2.0, "new": 0}
    with pytest.raises(Exception, match="zz"):
        P.custom_columns(df, ["zz"]).collect()


def test_clean_row_predicate(spark):
    df = spark.createDataFrame([(1.0, 1.0, "x"), (0.0, 1.0, "x"), (1.0, None, "x"), (1.0, 1.0, None)], "budget_x double, revenue double, n string")
    assert [r["ok"] for r in df.select(P.is_clean_row(df.columns).alias("ok")).collect()] == [True, False, False, False]


def test_genre_names_that_meet(spark):
    from shelfrank.operators.features import FeatureState, encode_genres

    genres = ["Drama", "drama", "Count", "List", "Sci. Fi"]
    df = spark.createDataFrame([("Drama, Count",), ("drama, Sci. Fi",), ("List",), (None,)], "genre string")
    columns = FeatureState(2025, {}, genres).columns[-4:]
    assert columns == ["genre_drama", "genre_count_genre", "genre_list_genre", "genre_sci__fi"]
    rows = encode_genres(df, genres).select("genre_count", *columns).collect()
    assert [tuple(r) for r in rows[:3]] == [(2, 1, 1, 0, 0), (2, 1, 0, 0, 1), (1, 0, 0, 1, 0)]
