"""Text preparation for embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.text import MIN_TEXT_LENGTH, clean_text, computed_once, genre_text
from shelfrank.operators.projections import min_length as keep_min_length


def preprocess_descriptions(df: DataFrame, column: str, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """Clean a text column and keep the rows whose result is long enough."""
    cleaned = df.withColumn(column, computed_once(clean_text(F.col(column))))
    return keep_min_length(cleaned, column, min_length)


def combined_text(
    df: DataFrame, min_length: int = MIN_TEXT_LENGTH, include_title: bool = True, include_genres: bool = True
) -> DataFrame:
    """``{title} {genres} {overview}`` as ``overview_processed``; blank parts are skipped, short results dropped."""
    parts = {}
    if include_title and "names" in df.columns:
        parts["title_processed"] = clean_text(F.col("names"))
    if include_genres and "genre" in df.columns:
        parts["genres_text"] = genre_text(F.col("genre"))
    prepared = df.withColumns(parts) if parts else df
    texts = [F.nullif(F.trim(c), F.lit("")) for c in parts] + [F.nullif(clean_text(F.col("overview")), F.lit(""))]
    joined = prepared.withColumn("overview_processed", computed_once(F.concat_ws(" ", *texts)))
    return keep_min_length(joined, "overview_processed", min_length)
