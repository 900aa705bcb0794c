"""Column selections and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions.text import MIN_TEXT_LENGTH, is_blank

CLUSTERING_COLUMNS = ("year", "score", "budget_x", "revenue")
SEMANTIC_COLUMNS = ("names", "overview", "genre", "score", "year", "revenue")


def custom_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns; an unknown one raises."""
    return df.select(*columns)


def available_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def columns_by_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [name for name in df.columns if name.startswith(prefix)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def supervised_view(clean: DataFrame) -> DataFrame:
    return clean


def clustering_view(clean: DataFrame) -> DataFrame:
    return available_columns(clean, ("item_id", *CLUSTERING_COLUMNS))


def semantic_view(clean: DataFrame) -> DataFrame:
    """Text columns of the rows that have an overview."""
    return available_columns(clean, ("item_id", *SEMANTIC_COLUMNS)).where(~is_blank(F.col("overview")))


def min_length(df: DataFrame, column: str, length: int = MIN_TEXT_LENGTH) -> DataFrame:
    return df.where(F.length(column) >= length)


def between_exclusive(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) > low) & (F.col(column) < high))


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in columns])


def is_clean_row(columns: Sequence[str], nonzero: Sequence[str] = ("budget_x", "revenue")) -> Column:
    """No NULL anywhere in the row and no zero in the amount columns."""
    zero = reduce(or_, [F.coalesce(F.col(name) == 0, F.lit(False)) for name in nonzero])
    return ~(zero | any_null(columns))


def align_columns(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` plus the wanted columns in their order; a missing one is added as 0."""
    return df.select(*keep, *[F.col(n) if n in df.columns else F.lit(0).alias(n) for n in wanted])


def members(df: DataFrame, ids: DataFrame, key: str = "item_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def non_members(df: DataFrame, ids: DataFrame, key: str = "item_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")
