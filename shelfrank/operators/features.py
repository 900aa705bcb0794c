"""Model features of catalog items."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.numbers import flag
from shelfrank.functions.text import comma_count, genre_list, word_count
from shelfrank.operators.cleaning import fill_medians, fit_medians, zero_fill
from shelfrank.operators.projections import align_columns
from shelfrank.scale import collect_bounded

# The model's numeric inputs, in order.
FEATURES = (
    "release_year", "movie_age", "is_recent", "budget_x", "revenue", "revenue_to_budget_ratio", "log_revenue",
    "log_budget", "has_budget", "has_revenue", "profit", "log_profit", "overview_length", "crew_size", "has_overview",
    "genre_count", "is_english", "is_us_production",
)
RECENT_YEARS = 5
TOP_GENRES = 10


RESERVED = ("genre_count", "genre_list")


@dataclass
class FeatureState:
    """What feature engineering learns from the training table."""

    as_of_year: int
    medians: dict[str, float | None] = field(default_factory=dict)
    genres: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [*FEATURES, *dict.fromkeys(genre_column(g) for g in self.genres)]


def genre_column(genre: str) -> str:
    """Name of a genre's flag.  Dots would need quoting everywhere, and two names belong to other columns."""
    name = f"genre_{genre.lower().replace(' ', '_').replace('.', '_').replace('`', '_')}"
    return f"{name}_genre" if name in RESERVED else name


def _age_columns(df: DataFrame, as_of_year: int) -> DataFrame:
    age = F.lit(as_of_year) - F.col("year")
    return df.withColumns({"release_year": F.col("year"), "movie_age": age, "is_recent": flag(age <= RECENT_YEARS)})


def fit_age_medians(df: DataFrame, as_of_year: int, row_bound: int | None = None) -> dict[str, float | None]:
    """Age is a shifted and mirrored year, so one exact median gives both."""
    year = fit_medians(df, ["year"], row_bound=row_bound)["year"]
    return {"release_year": year, "movie_age": None if year is None else as_of_year - year}


def temporal_features(
    df: DataFrame, as_of_year: int, medians: dict[str, float | None] | None = None, row_bound: int | None = None
) -> DataFrame:
    """Year, age and recency; recency is taken before missing years get the median."""
    if medians is None:
        medians = fit_age_medians(df, as_of_year, row_bound)
    return fill_medians(_age_columns(df, as_of_year), medians)


def financial_features(df: DataFrame) -> DataFrame:
    budget, revenue = F.col("budget_x"), F.col("revenue")
    profit = revenue - budget
    return df.withColumns(
        {
            "revenue_to_budget_ratio": F.try_divide(revenue, budget + 1),
            "log_revenue": F.log1p(revenue),
            "log_budget": F.log1p(budget),
            "has_budget": flag(budget > 0),
            "has_revenue": flag(revenue > 0),
            "profit": profit,
            "log_profit": F.when(profit.isNotNull(), F.log1p(F.greatest(profit, F.lit(0.0)))),
        }
    )


def text_features(df: DataFrame) -> DataFrame:
    words = word_count(F.col("overview"))
    return df.withColumns(
        {
            "overview_length": words,
            "crew_size": comma_count(F.col("crew")),
            "has_overview": flag(words > 0),
        }
    )


def genre_counts(df: DataFrame) -> DataFrame:
    """Rows per genre, most frequent first in ``orderBy(count desc, genre)`` terms; unordered here."""
    return (
        df.select(F.explode(genre_list(F.col("genre"))).alias("genre"))
        .groupBy("genre")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def fit_genres(df: DataFrame, top_n: int = TOP_GENRES) -> list[str]:
    """The ``top_n`` most frequent genres; ties by name."""
    top = genre_counts(df).orderBy(F.col("count").desc(), "genre").limit(top_n)
    return [row["genre"] for row in collect_bounded(top, top_n, "genre vocabulary")]


def encode_genres(df: DataFrame, genres: Sequence[str]) -> DataFrame:
    """Genre list, its size, and one 0/1 column per vocabulary entry; genres whose columns have one name share it."""
    listed = df.withColumn("genre_list", genre_list(F.col("genre")))
    named: dict[str, list[str]] = {}
    for genre in genres:
        named.setdefault(genre_column(genre), []).append(genre)
    held = {
        name: flag(reduce(Column.__or__, [F.array_contains("genre_list", g) for g in members])) for name, members in named.items()
    }
    return listed.withColumns({"genre_count": F.size("genre_list"), **held})


def category_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_english": flag(F.col("orig_lang") == "English"),
            "is_us_production": flag(F.col("country") == "US"),
        }
    )


def fit_features(
    df: DataFrame, as_of_year: int, top_n: int = TOP_GENRES, row_bound: int | None = None
) -> FeatureState:
    return FeatureState(as_of_year, fit_age_medians(df, as_of_year, row_bound), fit_genres(df, top_n))


def create_features(df: DataFrame, state: FeatureState) -> DataFrame:
    """All features, with the medians and genre vocabulary of ``state``."""
    return (
        temporal_features(df, state.as_of_year, state.medians)
        .transform(financial_features)
        .transform(text_features)
        .transform(encode_genres, state.genres)
        .transform(category_flags)
    )


def feature_matrix(
    df: DataFrame, state: FeatureState, target: str | None = "score", keep: Sequence[str] = ("item_id",)
) -> DataFrame:
    """Key, features in fitted order with missing values as 0, and the target as ``label``."""
    engineered = create_features(df, state)
    if target is not None:
        engineered = engineered.withColumn("label", F.col(target).cast("double"))
        keep = (*keep, "label")
    return zero_fill(align_columns(engineered, state.columns, keep), state.columns)


def refit_matrix(df: DataFrame, wanted: Sequence[str], as_of_year: int, keep: Sequence[str] = ("item_id",)) -> DataFrame:
    """Features learned anew from ``df`` itself, then matched to a model's column list."""
    state = fit_features(df, as_of_year)
    return zero_fill(align_columns(create_features(df, state), wanted, keep), list(wanted))
