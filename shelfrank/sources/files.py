"""CSV and Parquet scans and sinks of catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.operators.cleaning import clean_catalog
from shelfrank.operators.projections import clustering_view, semantic_view, supervised_view

# Texts read as missing, the usual data-frame tokens plus a single space.
NA_TOKENS = (
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

RAW_COLUMNS = (
    "names", "date_x", "score", "genre", "overview", "crew", "orig_title", "status", "orig_lang", "budget_x",
    "revenue", "country",
)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    na_tokens: Sequence[str] = NA_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """Quoted CSV with a header; NA tokens become NULL in text columns.

    Quoted line breaks need ``multi_line``, which reads each file in one task: store large inputs as many files, or
    pass ``multi_line=False`` when no value holds a line break, which makes files splittable.
    """
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    tokens = list(na_tokens)
    return raw.select(
        *[
            F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in raw.schema
        ]
    )


def write_csv(df: DataFrame, path: str) -> str:
    writer = df.write.option("header", True).option("quote", '"').option("escape", '"')
    # The writer trims values unless told otherwise.
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


def with_item_id(df: DataFrame) -> DataFrame:
    """Add ``item_id`` to a table without one.  Write the result before using it: the ids follow the read order."""
    return df if "item_id" in df.columns else df.withColumn("item_id", F.monotonically_increasing_id())


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return path


def _is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there to the end; an aborted write leaves no marker and counts as none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(spark._jvm.org.apache.hadoop.fs.Path(target, "_SUCCESS"))


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], in_memory: bool = False
) -> DataFrame:
    """The table stored at ``path``; when there is none, or only what an aborted write left, build it, write it and read it back."""
    if not _is_complete(spark, path):
        write_table(build(), path)
    stored = spark.read.parquet(path)
    return stored.persist() if in_memory else stored


def load_clean(spark: SparkSession, path: str, raw_csv: str | None = None) -> DataFrame:
    """Stored clean catalog, built from the raw CSV on first use."""

    def build() -> DataFrame:
        if raw_csv is None:
            raise ValueError(f"no table at {path} and no raw CSV to build it from")
        return with_item_id(clean_catalog(scan_csv(spark, raw_csv)))

    return materialize(spark, path, build)


def load_supervised(spark: SparkSession, path: str, raw_csv: str | None = None) -> DataFrame:
    return supervised_view(load_clean(spark, path, raw_csv))


def load_clustering(
    spark: SparkSession, path: str, raw_csv: str | None = None, save_to: str | None = None
) -> DataFrame:
    return _optionally_saved(clustering_view(load_clean(spark, path, raw_csv)), save_to)


def load_semantic(
    spark: SparkSession, path: str, raw_csv: str | None = None, save_to: str | None = None
) -> DataFrame:
    return _optionally_saved(semantic_view(load_clean(spark, path, raw_csv)), save_to)


def _optionally_saved(df: DataFrame, save_to: str | None) -> DataFrame:
    if save_to is None:
        return df
    write_table(df, save_to)
    return df.sparkSession.read.parquet(save_to)
