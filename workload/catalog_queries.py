"""Scans, cleaning, features, profiles, joins and ranking over the catalog and the documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions import numbers as N
from shelfrank.functions import text as X
from shelfrank.operators import cleaning as C
from shelfrank.operators import features as E
from shelfrank.operators import joins as J
from shelfrank.operators import projections as P
from shelfrank.operators import ranking as R
from shelfrank.operators import stats as S
from shelfrank.operators import title_index as T
from shelfrank.operators.text_prep import combined_text, preprocess_descriptions
from shelfrank.scale import cut_lineage, shared_folder
from shelfrank.sources import files
from shelfrank.sources.demo_catalog import table
from workload.registry import (
    AS_OF_YEAR,
    CLEAN_SQL,
    RAW_SQL,
    SEED,
    clean,
    query,
    raw,
    round_columns,
    rounded,
    row_bound,
)

TITLES = ["red widget", "BLUE", "ring", "no such title"]

# The SQL texts below use RE2, whose \s covers ASCII only, so the other spaces are listed.
SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def sql_clean_text(column: str) -> str:
    word = f"[^{SPACE}]+"
    text = f"lower(coalesce({column}, ''))"
    for pattern, by in (
        (f"http{word}|www{word}", ""),
        (f"{word}@{word}", ""),
        (f"[^a-zA-Z{SPACE}'']", " "),
        (f"[{SPACE}]+", " "),
    ):
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"trim({text})"


def sql_words(column: str) -> str:
    return f"CAST(len(regexp_extract_all(coalesce({column}, ''), '[^{SPACE}]+')) AS INTEGER)"


def sql_genres(column: str) -> str:
    return f"[trim(g) FOR g IN string_split({column}, ',')]"


# Scans and sinks


@query("parquet_scan", RAW_SQL + " SELECT item_id, names, genre, score, budget_x FROM raw")
def parquet_scan(spark, sf):
    path = files.write_table(raw(spark, sf, "names", "genre", "score", "budget_x"), shared_folder(spark, "scan"))
    return files.scan_parquet(spark, path)


@query("csv_roundtrip", RAW_SQL + """
  SELECT item_id, names, CASE WHEN date_x <> 'n/a' THEN date_x END AS date_x, score, genre, overview, crew, revenue FROM raw""")
def csv_roundtrip(spark, sf):
    source = raw(spark, sf, "names", "date_x", "score", "genre", "overview", "crew", "revenue")
    path = files.write_csv(source, shared_folder(spark, "csv"))
    schema = reduce(lambda s, f: s.add(f.name, "string"), source.schema, type(source.schema)())
    text = files.scan_csv(spark, path, schema)
    numbers = C.coerce_numeric(text, ["score", "revenue"])
    return numbers.withColumn("item_id", F.col("item_id").cast("bigint"))


@query("materialized_clean", CLEAN_SQL + " SELECT item_id, score, budget_x, revenue, year FROM clean")
def materialized_clean(spark, sf):
    path = shared_folder(spark, "clean")
    build = lambda: clean(spark, sf, "score", "budget_x", "revenue", "year")
    files.materialize(spark, path, build)
    return files.materialize(spark, path, build)


@query("partitioned_sink", CLEAN_SQL + " SELECT year, count(*) AS count FROM clean WHERE year >= 1998 GROUP BY year")
def partitioned_sink(spark, sf):
    path = files.write_table(
        clean(spark, sf, "year", "score").hint("rebalance", "year"), shared_folder(spark, "by-year"), partition_by=["year"]
    )
    stored = files.scan_parquet(spark, path).where("year >= 1998")
    return stored.groupBy("year").agg(F.count(F.lit(1)).alias("count"))


# Cleaning and projections


@query("clean_catalog", CLEAN_SQL + " SELECT * FROM clean")
def clean_catalog(spark, sf):
    return clean(spark, sf)


@query("median_fill", CLEAN_SQL + """
  SELECT 'budget_x' AS "column", quantile_cont(budget_x, 0.5) AS median FROM kept
  UNION ALL SELECT 'revenue', quantile_cont(revenue, 0.5) FROM kept""")
def median_fill(spark, sf):
    source = C.drop_missing_target(raw(spark, sf, "score", "budget_x", "revenue"))
    medians = C.fit_medians(source, row_bound=row_bound(spark, sf))
    return spark.createDataFrame(list(medians.items()), "column string, median double")


@query("zero_fill", RAW_SQL + """
  SELECT item_id, coalesce(score, 0) AS score, coalesce(budget_x, 0) AS budget_x, coalesce(revenue, 0) AS revenue FROM raw""")
def zero_fill(spark, sf):
    return C.zero_fill(raw(spark, sf, "score", "budget_x", "revenue"), ["score", "budget_x", "revenue"])


@query("inf_to_null", RAW_SQL + """
  SELECT item_id, round(CASE WHEN budget_x <> 0 THEN revenue / budget_x END, 6) AS ratio FROM raw""")
def inf_to_null(spark, sf):
    source = raw(spark, sf, "budget_x", "revenue")
    zero = F.col("budget_x") == 0
    ratio = F.when(zero, F.lit(float("inf"))).otherwise(F.try_divide("revenue", "budget_x"))
    return C.infinity_to_null(source.select("item_id", ratio.alias("ratio")), ["ratio"]).transform(round_columns, "ratio")


@query("semantic_projection", CLEAN_SQL + """
  SELECT item_id, names, overview, genre, score, year, revenue FROM clean WHERE trim(overview) <> ''""")
def semantic_projection(spark, sf):
    return P.semantic_view(clean(spark, sf, "names", "overview", "genre", "score", "year", "revenue"))


@query("clustering_projection", CLEAN_SQL + " SELECT item_id, year, score, budget_x, revenue FROM clean")
def clustering_projection(spark, sf):
    return P.clustering_view(clean(spark, sf, "names", "year", "score", "budget_x", "revenue"))


@query("supervised_view", CLEAN_SQL + " SELECT item_id, names, year, score, genre, orig_lang, country, budget_x, revenue FROM clean")
def supervised_view(spark, sf):
    view = P.supervised_view(clean(spark, sf, "names", "year", "score", "genre", "orig_lang", "country", "budget_x", "revenue"))
    return P.available_columns(view, ["item_id", "names", "year", "absent", "score", "genre", "orig_lang", "country", "budget_x", "revenue"])


@query("custom_columns", CLEAN_SQL + " SELECT names, country FROM clean")
def custom_columns(spark, sf):
    return P.custom_columns(clean(spark, sf, "names", "country"), ["names", "country"])


@query("numeric_projection", CLEAN_SQL + " SELECT item_id, year, score, budget_x, revenue FROM clean")
def numeric_projection(spark, sf):
    cleaned = clean(spark, sf, "names", "year", "score", "genre", "budget_x", "revenue")
    return cleaned.select(*P.numeric_columns(cleaned))


@query("clean_rows", CLEAN_SQL + """, flagged AS (
  SELECT NOT (budget_x = 0 OR revenue = 0 OR names IS NULL OR year IS NULL OR score IS NULL OR genre IS NULL OR overview IS NULL
    OR crew IS NULL OR orig_lang IS NULL OR country IS NULL OR quality_fixed IS NULL) AS ok FROM clean)
  SELECT count(*) FILTER (ok) AS clean_items, round(count(*) FILTER (ok) * 100.0 / count(*), 6) AS clean_percentage FROM flagged""")
def clean_rows(spark, sf):
    return S.clean_rows(clean(spark, sf)).transform(round_columns, "clean_percentage")


@query("range_filter", RAW_SQL + """
  SELECT item_id, round(roi, 6) AS roi FROM (SELECT item_id, CASE WHEN budget_x <> 0 THEN (revenue - budget_x) / budget_x * 100 END AS roi FROM raw)
  WHERE roi > -100 AND roi < 1000""")
def range_filter(spark, sf):
    source = raw(spark, sf, "budget_x", "revenue")
    roi = N.return_on_investment(F.col("revenue"), F.col("budget_x"))
    return P.between_exclusive(source.select("item_id", roi.alias("roi")), "roi", -100, 1000).transform(round_columns, "roi")


@query("positive_amounts", RAW_SQL + " SELECT item_id, budget_x, revenue FROM raw WHERE budget_x > 0 AND revenue > 0")
def positive_amounts(spark, sf):
    return raw(spark, sf, "budget_x", "revenue").where("budget_x > 0 and revenue > 0")


@query("min_length", f"""SELECT doc_id AS item_id, text FROM (SELECT doc_id, {sql_clean_text('text')} AS text FROM documents) WHERE length(text) >= 40""")
def min_length(spark, sf):
    return preprocess_descriptions(documents(spark, sf).select("item_id", "text"), "text", 40)


@query("membership", CLEAN_SQL + """
  SELECT item_id, names, item_id IN (SELECT doc_id FROM documents WHERE lang = 'en') AS listed FROM clean""")
def membership(spark, sf):
    cleaned = clean(spark, sf, "names")
    listed = documents(spark, sf).where("lang = 'en'")
    inside = P.members(cleaned, listed).withColumn("listed", F.lit(True))
    return inside.unionByName(P.non_members(cleaned, listed).withColumn("listed", F.lit(False)))


@query("zero_counts", RAW_SQL + " ".join(f"""{'UNION ALL' if i else ''}
  SELECT '{c}' AS "column", count(*) FILTER ({c} = 0) AS zeros, round(count(*) FILTER ({c} = 0) * 100.0 / count(*), 6) AS percent FROM raw"""
    for i, c in enumerate(("budget_x", "revenue", "score"))))
def zero_counts(spark, sf):
    return S.zero_counts(raw(spark, sf, "budget_x", "revenue", "score")).transform(round_columns, "percent")


# Features

TEMPORAL_SQL = f"""
  coalesce(CAST(year AS DOUBLE), (SELECT quantile_cont(CAST(year AS DOUBLE), 0.5) FROM clean)) AS release_year,
  coalesce(CAST({AS_OF_YEAR} - year AS DOUBLE), {AS_OF_YEAR} - (SELECT quantile_cont(CAST(year AS DOUBLE), 0.5) FROM clean)) AS movie_age,
  CASE WHEN {AS_OF_YEAR} - year <= 5 THEN 1 ELSE 0 END AS is_recent"""
FINANCIAL_SQL = """
  round(revenue / (budget_x + 1), 6) AS revenue_to_budget_ratio, round(ln(1 + revenue), 6) AS log_revenue,
  round(ln(1 + budget_x), 6) AS log_budget, CASE WHEN budget_x > 0 THEN 1 ELSE 0 END AS has_budget,
  CASE WHEN revenue > 0 THEN 1 ELSE 0 END AS has_revenue, round(revenue - budget_x, 6) AS profit,
  round(ln(1 + greatest(revenue - budget_x, 0)), 6) AS log_profit"""
TEXT_SQL = f"""
  {sql_words('overview')} AS overview_length, CAST(len(string_split(crew, ',')) AS INTEGER) AS crew_size,
  CASE WHEN {sql_words('overview')} > 0 THEN 1 ELSE 0 END AS has_overview"""
FLAGS_SQL = """
  CASE WHEN orig_lang = 'English' THEN 1 ELSE 0 END AS is_english, CASE WHEN country = 'US' THEN 1 ELSE 0 END AS is_us_production"""
FINANCIAL = ("revenue_to_budget_ratio", "log_revenue", "log_budget", "profit", "log_profit")
VOCABULARY_SQL = f"""vocabulary AS (
  SELECT genre FROM (SELECT genre, count(*) AS n FROM (SELECT unnest({sql_genres('genre')}) AS genre FROM clean) GROUP BY genre)
  ORDER BY n DESC, genre LIMIT 10)"""


@query("temporal_features", CLEAN_SQL + f" SELECT item_id, {TEMPORAL_SQL} FROM clean")
def temporal_features(spark, sf):
    cleaned = clean(spark, sf, "year")
    return E.temporal_features(cleaned, AS_OF_YEAR, row_bound=row_bound(spark, sf)).drop("year")


@query("financial_features", CLEAN_SQL + f" SELECT item_id, {FINANCIAL_SQL} FROM clean")
def financial_features(spark, sf):
    cleaned = E.financial_features(clean(spark, sf, "budget_x", "revenue")).drop("budget_x", "revenue")
    return round_columns(cleaned, *FINANCIAL)


@query("text_features", CLEAN_SQL + f" SELECT item_id, {TEXT_SQL} FROM clean")
def text_features(spark, sf):
    return E.text_features(clean(spark, sf, "overview", "crew")).drop("overview", "crew")


@query("genre_list_counts", RAW_SQL + f"""
  SELECT item_id, array_to_string({sql_genres("coalesce(genre, 'Unknown')")}, '|') AS genre_list,
    CAST(len(string_split(coalesce(genre, 'Unknown'), ',')) AS INTEGER) AS genre_count FROM raw""")
def genre_list_counts(spark, sf):
    listed = raw(spark, sf, "genre").withColumn("genre_list", X.genre_list(F.col("genre")))
    return listed.select("item_id", F.array_join("genre_list", "|").alias("genre_list"), F.size("genre_list").alias("genre_count"))


@query("genre_multi_hot", CLEAN_SQL + f""", {VOCABULARY_SQL}
  SELECT item_id, 'genre_' || replace(lower(v.genre), ' ', '_') AS feature,
    CASE WHEN list_contains({sql_genres('clean.genre')}, v.genre) THEN 1 ELSE 0 END AS value FROM clean, vocabulary v""")
def genre_multi_hot(spark, sf):
    cleaned = clean(spark, sf, "genre")
    genres = E.fit_genres(cleaned)
    encoded = E.encode_genres(cleaned, genres)
    columns = [E.genre_column(g) for g in genres]
    # Which ten genres lead depends on the data, so the 0/1 columns are reported in long form.
    return encoded.select("item_id", *columns).unpivot(["item_id"], columns, "feature", "value")


@query("category_flags", CLEAN_SQL + f" SELECT item_id, {FLAGS_SQL} FROM clean")
def category_flags(spark, sf):
    return E.category_flags(clean(spark, sf, "orig_lang", "country")).drop("orig_lang", "country")


@query("feature_matrix", CLEAN_SQL + f""", {VOCABULARY_SQL}, encoded AS (
  SELECT item_id, list_sum([CASE WHEN list_contains({sql_genres('clean.genre')}, g) THEN 1 ELSE 0 END FOR g IN (SELECT list(genre) FROM vocabulary)]) AS hits FROM clean)
  SELECT clean.item_id, score AS label, budget_x, revenue, {TEMPORAL_SQL}, {FINANCIAL_SQL}, {TEXT_SQL}, {FLAGS_SQL},
    CAST(len(string_split(genre, ',')) AS INTEGER) AS genre_count, CAST(hits AS BIGINT) AS vocabulary_hits
  FROM clean JOIN encoded USING (item_id)""")
def feature_matrix(spark, sf):
    cleaned = clean(spark, sf)
    state = E.fit_features(cleaned, AS_OF_YEAR, row_bound=row_bound(spark, sf))
    matrix = E.feature_matrix(cleaned, state)
    hits = reduce(lambda a, b: a + b, [F.col(E.genre_column(g)) for g in state.genres])
    return round_columns(
        matrix.select("item_id", "label", *E.FEATURES, hits.cast("bigint").alias("vocabulary_hits")), *FINANCIAL
    )


# Text


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").withColumnRenamed("doc_id", "item_id")


@query("clean_text", f"SELECT doc_id AS item_id, {sql_clean_text('text')} AS text FROM documents")
def clean_text(spark, sf):
    return documents(spark, sf).select("item_id", X.clean_text(F.col("text")).alias("text"))


@query("genre_tokens", RAW_SQL + f"""
  SELECT item_id, array_to_string([replace(lower(trim(g)), ' ', '_') FOR g IN string_split(coalesce(genre, ''), ',') IF trim(g) NOT IN ('', 'Unknown')], ' ') AS tokens FROM raw""")
def genre_tokens(spark, sf):
    return raw(spark, sf, "genre").select("item_id", X.genre_text(F.col("genre")).alias("tokens"))


@query("combined_text", CLEAN_SQL + f""", parts AS (
  SELECT item_id, {sql_clean_text('names')} AS title_processed, {sql_clean_text('overview')} AS body,
    array_to_string([replace(lower(trim(g)), ' ', '_') FOR g IN string_split(genre, ',') IF trim(g) NOT IN ('', 'Unknown')], ' ') AS genres_text
  FROM clean)
  SELECT * FROM (SELECT item_id, title_processed, genres_text,
    concat_ws(' ', nullif(title_processed, ''), nullif(genres_text, ''), nullif(body, '')) AS overview_processed FROM parts)
  WHERE length(overview_processed) >= 10""")
def combined(spark, sf):
    prepared = combined_text(P.semantic_view(clean(spark, sf, "names", "genre", "overview")))
    return prepared.select("item_id", "title_processed", "genres_text", "overview_processed")


@query("text_lengths", f"""
  SELECT doc_id AS item_id, {sql_words('text')} AS words, CAST(length(text) AS INTEGER) AS chars,
    CAST(len(string_split(text, ',')) AS INTEGER) AS parts FROM documents""")
def text_lengths(spark, sf):
    text = F.col("text")
    return documents(spark, sf).select(
        "item_id", X.word_count(text).alias("words"), X.char_count(text).alias("chars"), X.comma_count(text).alias("parts")
    )


@query("text_stats", f"""WITH lengths AS (SELECT {sql_words('text')} AS w, length(text) AS c FROM documents)
  SELECT count(*) AS total_descriptions, round(avg(w), 6) AS avg_word_count, quantile_cont(CAST(w AS DOUBLE), 0.5) AS median_word_count,
    min(w) AS min_word_count, max(w) AS max_word_count, round(avg(c), 6) AS avg_char_count,
    quantile_cont(CAST(c AS DOUBLE), 0.5) AS median_char_count, CAST(min(c) AS INTEGER) AS min_char_count, CAST(max(c) AS INTEGER) AS max_char_count FROM lengths""")
def text_stats(spark, sf):
    source = documents(spark, sf)
    return S.text_stats(source, "text", row_bound=source.count()).transform(round_columns, "avg_word_count", "avg_char_count")


# Scalars


@query("score_buckets", RAW_SQL + """, banded AS (SELECT CASE WHEN score > 0 AND score <= 40 THEN 'Low (0-40)' WHEN score > 40 AND score <= 60 THEN 'Medium (40-60)'
    WHEN score > 60 AND score <= 80 THEN 'Good (60-80)' WHEN score > 80 AND score <= 100 THEN 'Excellent (80-100)' END AS band FROM raw)
  SELECT band, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM raw), 6) AS percent FROM banded WHERE band IS NOT NULL GROUP BY band""")
def score_buckets(spark, sf):
    source = raw(spark, sf, "score")
    counts = S.value_counts(source, N.score_band(F.col("score")), "band")
    return S.with_share(counts, source).transform(round_columns, "percent")


@query("decade_counts", CLEAN_SQL + """
  SELECT CAST(year // 10 * 10 AS INTEGER) AS decade, count(*) AS count, round(avg(score), 6) AS score_mean FROM clean WHERE year IS NOT NULL GROUP BY 1""")
def decade_counts(spark, sf):
    dated = clean(spark, sf, "year", "score").withColumn("decade", N.decade(F.col("year")))
    means = S.group_means(dated, "decade").transform(round_columns, "score_mean")
    return S.group_counts(dated, "decade").join(means, "decade")


@query("year_counts", CLEAN_SQL + " SELECT year, count(*) AS count FROM clean WHERE year IS NOT NULL GROUP BY year")
def year_counts(spark, sf):
    return S.group_counts(clean(spark, sf, "year"), "year")


@query("group_means", CLEAN_SQL + " SELECT year, round(avg(score), 6) AS score_mean FROM clean WHERE year IS NOT NULL GROUP BY year")
def group_means(spark, sf):
    return S.group_means(clean(spark, sf, "year", "score"), "year").transform(round_columns, "score_mean")


@query("roi_stats", RAW_SQL + """, r AS (SELECT CASE WHEN budget_x <> 0 THEN (revenue - budget_x) / budget_x * 100 END AS roi FROM raw)
  SELECT 'roi' AS "column", count(roi) AS count, round(avg(roi), 6) AS mean, round(quantile_cont(roi, 0.5), 6) AS median FROM r""")
def roi_stats(spark, sf):
    source = raw(spark, sf, "budget_x", "revenue")
    roi = source.select(N.return_on_investment(F.col("revenue"), F.col("budget_x")).alias("roi"))
    described = S.describe(roi, ["roi"], row_bound=row_bound(spark, sf))
    return described.select("column", "count", rounded("mean"), rounded("median"))


@query("first_genre_share", CLEAN_SQL + """, f AS (SELECT trim(split_part(genre, ',', 1)) AS genre FROM clean)
  SELECT genre, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM f), 6) AS percent FROM f GROUP BY genre ORDER BY count DESC, genre LIMIT 8""")
def first_genre_share(spark, sf):
    cleaned = clean(spark, sf, "genre")
    counts = S.top_counts(S.value_counts(cleaned, X.first_genre(F.col("genre")), "genre"), "genre", 8)
    return S.with_share(counts, cleaned).transform(round_columns, "percent")


@query("has_genre", CLEAN_SQL + """
  SELECT genre NOT IN ('', 'Unknown') AS has_genre, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM clean), 6) AS percent FROM clean GROUP BY 1""")
def has_genre(spark, sf):
    cleaned = clean(spark, sf, "genre")
    counts = S.value_counts(cleaned, X.has_genre(F.col("genre")), "has_genre")
    return S.with_share(counts, cleaned).transform(round_columns, "percent")


@query("log10_positive", RAW_SQL + """
  SELECT item_id, round(CASE WHEN budget_x > 0 THEN log10(budget_x) END, 6) AS log_budget, round(CASE WHEN revenue > 0 THEN log10(revenue) END, 6) AS log_revenue FROM raw""")
def log10_positive(spark, sf):
    return raw(spark, sf, "budget_x", "revenue").select(
        "item_id",
        rounded(N.log10_positive(F.col("budget_x")), alias="log_budget"),
        rounded(N.log10_positive(F.col("revenue")), alias="log_revenue"),
    )


@query("clip_score", RAW_SQL + " SELECT item_id, least(greatest(score * 1.5 - 20, 0.0), 100.0) AS clipped FROM raw WHERE score IS NOT NULL UNION ALL SELECT item_id, NULL FROM raw WHERE score IS NULL")
def clip_score(spark, sf):
    return raw(spark, sf, "score").select("item_id", N.clip(F.col("score") * 1.5 - 20).alias("clipped"))


@query("title_predicates", CLEAN_SQL + """
  SELECT item_id, lower(names) = 'red widget' AS same, contains(lower(names), 'ring') AS part, regexp_matches(lower(names), '^(red|blue) r') AS pattern, trim(lower(names)) AS key FROM clean""")
def title_predicates(spark, sf):
    name = F.col("names")
    return clean(spark, sf, "names").select(
        "item_id",
        X.title_equals(name, "Red Widget").alias("same"),
        X.title_contains(name, "Ring").alias("part"),
        X.title_contains(name, "^(red|blue) r", regex=True).alias("pattern"),
        X.match_key(name).alias("key"),
    )


# Profiles


@query("dataset_stats", CLEAN_SQL + """
  SELECT count(*) AS total_items, CAST(12 AS BIGINT) AS total_columns, round(avg(score), 6) AS score_mean, round(stddev_samp(score), 6) AS score_std,
    min(score) AS score_min, max(score) AS score_max, count(*) FILTER (budget_x IS NULL) AS missing_budget,
    count(*) FILTER (revenue IS NULL) AS missing_revenue, min(year) AS year_min, max(year) AS year_max FROM clean""")
def dataset_stats(spark, sf):
    return S.dataset_stats(clean(spark, sf)).transform(round_columns, "score_mean", "score_std")


@query("duplicate_titles", CLEAN_SQL + """
  SELECT count(*) AS duplicate_titles, CAST(sum(n) AS BIGINT) AS duplicate_title_rows FROM (SELECT count(*) AS n FROM clean WHERE names IS NOT NULL GROUP BY names HAVING count(*) > 1)""")
def duplicate_titles(spark, sf):
    return S.duplicate_titles(clean(spark, sf, "names"))


NULLABLE = (
    "item_id", "names", "date_x", "score", "genre", "overview", "crew", "orig_lang", "country", "budget_x", "revenue", "quality_fixed",
)


@query("null_report", RAW_SQL + " SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls, round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 6) AS percent FROM raw""" for c in NULLABLE
) + ") WHERE nulls > 0")
def null_report(spark, sf):
    return S.missing_report(raw(spark, sf).select(*NULLABLE)).transform(round_columns, "percent")


@query("rows_with_any_null", RAW_SQL + f" SELECT count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in NULLABLE)}) AS rows_with_any_null FROM raw")
def rows_with_any_null(spark, sf):
    return S.rows_with_any_null(raw(spark, sf).select(*NULLABLE))


@query("describe_numeric", CLEAN_SQL + " UNION ALL ".join(
    f""" SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
    round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median,
    round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM clean""" for c in ("score", "budget_x", "revenue", "year")))
def describe_numeric(spark, sf):
    cleaned = clean(spark, sf, "score", "budget_x", "revenue", "year")
    described = S.describe(cleaned, ["score", "budget_x", "revenue", "year"], row_bound=row_bound(spark, sf))
    return round_columns(described, "mean", "std", "q25", "median", "q75", digits=4)


@query("duplicate_rows", """SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM (
  SELECT count(*) AS n FROM (SELECT p_name, p_brand, p_type, p_size FROM part) GROUP BY p_name, p_brand, p_type, p_size)""")
def duplicate_rows(spark, sf):
    return S.duplicate_rows(table(spark, sf, "part").select("p_name", "p_brand", "p_type", "p_size"))


@query("repeated_titles", CLEAN_SQL + """
  SELECT item_id, names, title_rows FROM (SELECT item_id, names, count(*) OVER (PARTITION BY names) AS title_rows FROM clean) WHERE title_rows > 1""")
def repeated_titles(spark, sf):
    return S.repeated_titles(clean(spark, sf, "names"))


SHOWN = ("item_id", "names", "year", "score", "genre", "overview", "crew", "orig_lang", "country", "budget_x", "revenue", "quality_fixed")
SHOWN_TYPES = ("bigint", "string", "int", "double", "string", "string", "string", "string", "string", "double", "double", "double")


@query("schema_overview", CLEAN_SQL + " UNION ALL ".join(
    f""" SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count({c}) AS non_null FROM clean""" for i, (c, t) in enumerate(zip(SHOWN, SHOWN_TYPES))))
def schema_overview(spark, sf):
    return S.schema_overview(clean(spark, sf).select(*SHOWN))


REPORT_SQL = f"""
  SELECT 'basic' AS section, unnest(['total_items', 'total_columns', 'score_mean', 'score_std', 'score_min', 'score_max', 'missing_budget', 'missing_revenue', 'year_min', 'year_max']) AS metric,
    unnest([CAST(count(*) AS DOUBLE), 9.0, avg(score), stddev_samp(score), min(score), max(score), count(*) FILTER (budget_x IS NULL), count(*) FILTER (revenue IS NULL), min(year), max(year)]) AS value FROM clean
  UNION ALL SELECT 'duplicates', unnest(['duplicate_titles', 'duplicate_title_rows']), unnest([CAST(count(*) AS DOUBLE), CAST(sum(n) AS DOUBLE)])
    FROM (SELECT count(*) AS n FROM clean GROUP BY names HAVING count(*) > 1)
  UNION ALL SELECT 'nulls', 'rows_with_any_null', count(*) FILTER (year IS NULL) FROM clean
  UNION ALL SELECT 'quality', unnest(['clean_items', 'clean_percentage', 'budget_x_zero', 'revenue_zero', 'score_zero']),
    unnest([CAST(count(*) FILTER (ok) AS DOUBLE), count(*) FILTER (ok) * 100.0 / count(*), count(*) FILTER (budget_x = 0), count(*) FILTER (revenue = 0), count(*) FILTER (score = 0)])
    FROM (SELECT *, NOT (budget_x = 0 OR revenue = 0 OR year IS NULL) AS ok FROM clean)
  UNION ALL SELECT 'nulls_per_column', unnest(['item_id', 'names', 'year', 'score', 'genre', 'orig_lang', 'country', 'budget_x', 'revenue']),
    unnest([0, 0, count(*) FILTER (year IS NULL), 0, 0, 0, 0, 0, 0]) FROM clean
  UNION ALL (SELECT 'top_genre', g, count(*) AS n FROM (SELECT unnest({sql_genres('genre')}) AS g FROM clean) GROUP BY g ORDER BY n DESC, g LIMIT 5)
  UNION ALL SELECT 'distinct_genre', 'distinct_values', count(DISTINCT g) FROM (SELECT unnest({sql_genres('genre')}) AS g FROM clean)
  UNION ALL (SELECT 'top_orig_lang', orig_lang, count(*) AS n FROM clean GROUP BY orig_lang ORDER BY n DESC, orig_lang LIMIT 3)
  UNION ALL SELECT 'distinct_orig_lang', 'distinct_values', count(DISTINCT orig_lang) FROM clean
  UNION ALL (SELECT 'top_country', country, count(*) AS n FROM clean GROUP BY country ORDER BY n DESC, country LIMIT 3)
  UNION ALL SELECT 'distinct_country', 'distinct_values', count(DISTINCT country) FROM clean"""


@query("stats_report", CLEAN_SQL + f", report AS ({REPORT_SQL}) SELECT section, metric, round(value, 6) AS value FROM report")
def stats_report(spark, sf):
    cleaned = clean(spark, sf, "names", "year", "score", "genre", "orig_lang", "country", "budget_x", "revenue")
    return S.stats_report(cleaned).transform(round_columns, "value")


# Categories


@query("top_genres", RAW_SQL + f"""
  SELECT genre, count(*) AS count, round(avg(score), 6) AS mean_score FROM (SELECT unnest({sql_genres('genre')}) AS genre, score FROM raw WHERE genre IS NOT NULL)
  GROUP BY genre ORDER BY count DESC, genre LIMIT 10""")
def top_genres(spark, sf):
    listed = raw(spark, sf, "genre", "score").select(F.explode(X.split_list(F.col("genre"))).alias("genre"), "score")
    counted = listed.groupBy("genre").agg(F.count(F.lit(1)).alias("count"), rounded(F.avg("score"), alias="mean_score"))
    return S.top_counts(counted, "genre", 10)


@query("genre_frequency", RAW_SQL + f"""
  SELECT genre, count(*) AS count FROM (SELECT unnest({sql_genres('genre')}) AS genre FROM raw WHERE genre IS NOT NULL) GROUP BY genre ORDER BY count DESC, genre LIMIT 15""")
def genre_frequency(spark, sf):
    return S.top_counts(S.list_value_counts(raw(spark, sf, "genre")), "genre", 15)


@query("top_categories", CLEAN_SQL + " UNION ALL ".join(
    f""" (SELECT '{c}' AS category, {c} AS value, count(*) AS count, (SELECT count(DISTINCT {c}) FROM clean) AS distinct_values
    FROM clean GROUP BY {c} ORDER BY count DESC, value LIMIT 10)""" for c in ("orig_lang", "country")))
def top_categories(spark, sf):
    names = ["orig_lang", "country"]
    counts = cut_lineage(S.tagged_counts(clean(spark, sf, *names), names), "category-counts")
    parts = []
    for name in names:
        own = counts.where(F.col("kind") == name).select(F.col("kind").alias("category"), F.col("entry").alias("value"), "count")
        distinct = S.distinct_values(own).scalar().alias("distinct_values")
        parts.append(S.top_counts(own, "value", 10).select("category", "value", "count", distinct))
    return reduce(DataFrame.unionByName, parts)


@query("genre_mean_score", RAW_SQL + f""", vocabulary AS (
  SELECT g FROM (SELECT g, count(*) AS n FROM (SELECT unnest({sql_genres('genre')}) AS g FROM raw WHERE genre IS NOT NULL) GROUP BY g) ORDER BY n DESC, g LIMIT 10)
  SELECT g AS genre, round(avg(score), 6) AS mean_score, CASE WHEN avg(score) > (SELECT avg(score) FROM raw) THEN 1 ELSE 0 END AS above_mean
  FROM raw JOIN vocabulary ON contains(lower(genre), lower(g)) GROUP BY g""")
def genre_mean_score(spark, sf):
    source = raw(spark, sf, "genre", "score")
    genres = S.collect_top(S.list_value_counts(source), "genre", 10)
    return S.genre_mean_scores(source, genres).transform(round_columns, "mean_score")


# Distributions

CORRELATED = ("score", "budget_x", "revenue", "year")


@query("corr_matrix", CLEAN_SQL + " UNION ALL ".join(
    f" SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM clean" for a in CORRELATED for b in CORRELATED))
def corr_matrix(spark, sf):
    return S.correlation(clean(spark, sf, *CORRELATED), CORRELATED).transform(round_columns, "correlation")


@query("histogram", CLEAN_SQL + """, span AS (SELECT min(revenue) AS lo, (max(revenue) - min(revenue)) / 50 AS w FROM clean)
  SELECT CAST(least(floor((revenue - lo) / w), 49) AS INTEGER) AS bin, round(any_value(lo + least(floor((revenue - lo) / w), 49) * w), 4) AS bin_start, count(*) AS count FROM clean, span GROUP BY 1""")
def histogram(spark, sf):
    return S.histogram(clean(spark, sf, "revenue"), "revenue", 50).transform(round_columns, "bin_start", digits=4)


@query("boxplot_stats", CLEAN_SQL + """, q AS (SELECT quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.5) AS median, quantile_cont(revenue, 0.75) AS q3 FROM clean)
  SELECT round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
    min(CASE WHEN revenue >= q1 - 1.5 * (q3 - q1) THEN revenue END) AS whisker_low, max(CASE WHEN revenue <= q3 + 1.5 * (q3 - q1) THEN revenue END) AS whisker_high,
    count(*) FILTER (revenue < q1 - 1.5 * (q3 - q1) OR revenue > q3 + 1.5 * (q3 - q1)) AS outliers FROM clean, q""")
def boxplot_stats(spark, sf):
    return S.boxplot_stats(clean(spark, sf, "revenue"), "revenue", row_bound(spark, sf)).transform(round_columns, "q1", "median", "q3", digits=4)


@query("density_grid", CLEAN_SQL + """, s AS (SELECT count(score) AS n, stddev_samp(score) * pow(count(score), -0.2) AS h,
    min(score) - 0.5 * (max(score) - min(score)) AS start, 2 * (max(score) - min(score)) / 99 AS step FROM clean),
  grid AS (SELECT CAST(i AS INTEGER) AS point, start + i * step AS position FROM s, range(100) t(i))
  SELECT point, round(position, 6) AS position, round(sum(exp(-pow((score - position) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density FROM clean, s, grid GROUP BY point, position""")
def density_grid(spark, sf):
    dense = S.density(clean(spark, sf, "score"), "score", 100)
    return dense.select("point", rounded("position"), rounded("density", 9))


@query("fit_line", CLEAN_SQL + " SELECT round(regr_slope(quality_fixed, score), 6) AS slope, round(regr_intercept(quality_fixed, score), 6) AS intercept FROM clean")
def fit_line(spark, sf):
    return S.fit_line(clean(spark, sf, "score", "quality_fixed"), "score", "quality_fixed").transform(round_columns, "slope", "intercept")


# Titles and joins


def sql_resolve(titles) -> str:
    return " UNION ALL ".join(
        f"""SELECT {i} AS position, '{t}' AS query, coalesce(min(CASE WHEN lower(names) = '{t.lower()}' THEN item_id END),
        min(CASE WHEN contains(lower(names), '{t.lower()}') THEN item_id END)) AS item_id FROM clean"""
        for i, t in enumerate(titles)
    )


@query("title_lookup", CLEAN_SQL + sql_resolve(TITLES))
def title_lookup(spark, sf):
    return J.resolve_titles(clean(spark, sf, "names"), TITLES)


@query("title_suggestions", CLEAN_SQL + " SELECT item_id, names FROM clean WHERE contains(lower(names), 'ring') ORDER BY item_id LIMIT 5")
def title_suggestions(spark, sf):
    return J.title_suggestions(clean(spark, sf, "names"), "Ring")


@query("title_list", CLEAN_SQL + """, asked AS (
    SELECT DISTINCT unnest([upper(names), substr(names, 2, 5), substr(names, 3, 2), substr(names, 1, 1), names || '?']) AS query FROM clean),
  found AS (SELECT query, coalesce(min(item_id) FILTER (lower(names) = lower(query)), min(item_id)) AS item_id
    FROM asked JOIN (SELECT names, min(item_id) AS item_id FROM clean GROUP BY names) ON contains(lower(names), lower(query)) GROUP BY query)
  SELECT query, item_id FROM asked LEFT JOIN found USING (query)""")
def title_list(spark, sf):
    """Every title and pieces of it as queries, all in one pass over the index."""
    catalog = clean(spark, sf, "names")
    pieces = F.array(F.upper("names"), F.substring("names", 2, 5), F.substring("names", 3, 2), F.substring("names", 1, 1), F.concat("names", F.lit("?")))
    return T.resolve_list(T.title_index(catalog), catalog.select(F.explode(pieces).alias("query")))


@query("title_to_cluster_id", CLEAN_SQL + " SELECT query, max(item_id) AS item_id FROM clean JOIN (SELECT unnest(['Red Widget ', 'blue bolt', 'absent']) AS query) ON trim(lower(names)) = trim(lower(query)) GROUP BY query")
def title_to_cluster_id(spark, sf):
    return J.cluster_ids_of_titles(clean(spark, sf, "names"), ["Red Widget ", "blue bolt", "absent"])


@query("left_join_report", CLEAN_SQL + " SELECT part.p_partkey AS item_id, p_type, names, year FROM part LEFT JOIN clean ON item_id = p_partkey")
def left_join_report(spark, sf):
    left = table(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    return J.attach_columns(left, clean(spark, sf, "names", "year"), ["names", "year"])


@query("score_lookup_join", CLEAN_SQL + """, last AS (SELECT trim(lower(names)) AS k, arg_max(quality_fixed, item_id) AS s FROM clean GROUP BY 1)
  SELECT raw.item_id, raw.names, coalesce(s, 0) AS quality_fixed FROM raw LEFT JOIN last ON trim(lower(raw.names)) = k""")
def score_lookup_join(spark, sf):
    return J.score_by_title(raw(spark, sf, "names"), clean(spark, sf, "names", "quality_fixed"), "quality_fixed")


@query("score_by_id", CLEAN_SQL + " SELECT p_partkey AS item_id, coalesce(score, 0) AS score FROM part LEFT JOIN clean ON item_id = p_partkey")
def score_by_id(spark, sf):
    return J.score_by_id(table(spark, sf, "part").select(F.col("p_partkey").alias("item_id")), clean(spark, sf, "score"), "score")


@query("pool_union_difference", CLEAN_SQL + """
  SELECT item_id FROM clean WHERE (budget_x > 95000 OR revenue > 2000000) AND item_id NOT IN (SELECT vec_id FROM embeddings)""")
def pool_union_difference(spark, sf):
    cleaned = clean(spark, sf, "budget_x", "revenue")
    rich, popular = cleaned.where("budget_x > 95000"), cleaned.where("revenue > 2000000")
    references = table(spark, sf, "embeddings").select(F.col("vec_id").alias("item_id"))
    return J.id_difference(J.id_union(rich, popular), references)


@query("pool_intersection", CLEAN_SQL + " SELECT item_id FROM clean WHERE budget_x > 95000 AND revenue > 2000000")
def pool_intersection(spark, sf):
    cleaned = clean(spark, sf, "budget_x", "revenue")
    return J.id_intersection(cleaned.where("budget_x > 95000"), cleaned.where("revenue > 2000000"))


@query("genre_overlap_flags", CLEAN_SQL + f" SELECT item_id, list_has_any({sql_genres('genre')}, ['SMALL', 'Brand#3', 'Unknown']) AS shared FROM clean")
def genre_overlap_flags(spark, sf):
    wanted = F.array(*[F.lit(g) for g in ("SMALL", "Brand#3", "Unknown")])
    return clean(spark, sf, "genre").select("item_id", J.lists_overlap(X.genre_list(F.col("genre")), wanted).alias("shared"))


# Ranking and sampling


@query("top_n", CLEAN_SQL + " SELECT item_id, names, revenue FROM clean ORDER BY revenue DESC, item_id LIMIT 20")
def top_n(spark, sf):
    return R.top_n(clean(spark, sf, "names", "revenue"), "revenue", 20)


@query("n_largest", CLEAN_SQL + " SELECT item_id, names, score FROM clean ORDER BY score DESC, item_id LIMIT 15")
def n_largest(spark, sf):
    return R.n_largest(clean(spark, sf, "names", "score"), "score", 15)


@query("best_per_title", CLEAN_SQL + " SELECT item_id, names, score FROM (SELECT *, row_number() OVER (PARTITION BY names ORDER BY score DESC, item_id) AS r FROM clean) WHERE r = 1")
def best_per_title(spark, sf):
    return R.best_per_title(clean(spark, sf, "names", "score"), "score").select("item_id", "names", "score")


@query("hash_sample", CLEAN_SQL + f" SELECT item_id, names FROM clean ORDER BY substr(md5(item_id || '-{SEED}'), 1, 15), item_id LIMIT 100")
def hash_sample(spark, sf):
    return R.hash_sample(clean(spark, sf, "names"), 100, SEED).select("item_id", "names")


@query("group_sample", CLEAN_SQL + f"""
  SELECT item_id, country FROM (SELECT item_id, country, row_number() OVER (PARTITION BY country ORDER BY substr(md5(item_id || '-{SEED}'), 1, 15), item_id) AS r FROM clean) WHERE r <= 20""")
def group_sample(spark, sf):
    return R.hash_sample_per_group(clean(spark, sf, "country"), "country", 20, SEED)


@query("row_index", CLEAN_SQL + " SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS row_index FROM clean")
def row_index(spark, sf):
    return R.with_row_index(clean(spark, sf, "score").select("item_id"))


def sql_draw(side: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(pair_id || '-{side}-{seed}'), 1, 15) AS BIGINT)"


@query("random_pairs", CLEAN_SQL + f""", indexed AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS i FROM clean),
  drawn AS (SELECT pair_id, {sql_draw('a', SEED)} % (SELECT count(*) FROM clean) AS a, {sql_draw('b', SEED)} % (SELECT count(*) FROM clean) AS b FROM range(10000) t(pair_id))
  SELECT pair_id, x.item_id AS id_a, y.item_id AS id_b FROM drawn JOIN indexed x ON x.i = a JOIN indexed y ON y.i = b""")
def random_pairs(spark, sf):
    return R.random_pairs(clean(spark, sf, "score").select("item_id"), 10_000, SEED)
