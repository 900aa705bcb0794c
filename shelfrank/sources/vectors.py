"""Embedding tables: the array layout, the wide layout, and their conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "embed_"


def wide_columns(df: DataFrame, prefix: str = PREFIX) -> list[str]:
    """Vector component columns in numeric order."""
    names = [c for c in df.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    return sorted(names, key=lambda c: int(c[len(prefix) :]))


def wide_to_array(df: DataFrame, column: str = "embedding", prefix: str = PREFIX) -> DataFrame:
    parts = wide_columns(df, prefix)
    if not parts:
        raise ValueError(f"no columns named {prefix}<number>")
    vector = F.array(*[F.col(c).cast("float") for c in parts])
    return df.select(*[c for c in df.columns if c not in parts], vector.alias(column))


def array_to_wide(df: DataFrame, dimension: int, column: str = "embedding", prefix: str = PREFIX) -> DataFrame:
    """One column for each component; a vector of another length is an error, a null vector gives nulls."""
    others = [c for c in df.columns if c != column]
    fits = F.col(column).isNull() | (F.size(column) == dimension)
    wrong = F.raise_error(F.concat(F.lit(f"expected {dimension} components, found "), F.size(column).cast("string")))
    checked = F.when(fits, F.col(column)).otherwise(wrong.cast(df.schema[column].dataType))
    return df.select(*others, checked.alias(column)).select(*others, *[F.col(column)[i].alias(f"{prefix}{i}") for i in range(dimension)])


def save_embeddings(df: DataFrame, path: str, format: str = "parquet") -> str:
    """Store an item table with its ``embedding`` column."""
    if format != "parquet":
        raise ValueError(f"unsupported embedding format: {format}")
    if "embedding" not in df.columns or "item_id" not in df.columns:
        raise ValueError("an embedding table needs item_id and embedding")
    df.write.mode("overwrite").parquet(path)
    return path


def load_embeddings(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """An embedding table in the array layout, whichever layout is stored."""
    if format != "parquet":
        raise ValueError(f"unsupported embedding format: {format}")
    stored = spark.read.parquet(path)
    return stored if "embedding" in stored.columns else wide_to_array(stored)
