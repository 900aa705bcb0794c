"""Query registry: every entry runs on the given tables; most have an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.operators.cleaning import clean_catalog
from shelfrank.scale import cut_lineage
from shelfrank.sources.demo_catalog import raw_catalog, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF_YEAR = 2025
SEED = 42

# DuckDB counterparts of the demo catalog and its cleaning, used as common table expressions.
_LI = """li AS (
  SELECT l_partkey, min(l_shipdate) AS first_ship, bit_or(CAST(1 AS BIGINT) << (l_suppkey % 40)) AS crew_bits,
         sum(CAST(floor(l_extendedprice * (1 - l_discount) * 100) AS BIGINT)) AS cents
  FROM lineitem GROUP BY l_partkey)"""
_RAW = """raw AS (
  SELECT p_partkey AS item_id, p_name AS names,
    CASE WHEN p_partkey % 23 = 0 THEN 'n/a' ELSE strftime(first_ship, '%m/%d/%Y') END AS date_x,
    CASE WHEN p_partkey % 29 <> 0 THEN CAST(p_size AS DOUBLE) * 2 END AS score,
    CASE WHEN p_partkey % 19 <> 0 THEN p_type || ', ' || p_brand END AS genre,
    text AS overview,
    array_to_string(['Crew ' || i FOR i IN range(40) IF (crew_bits >> i) & 1 = 1], ', ') AS crew,
    CASE WHEN lang = 'en' THEN 'English' ELSE lang END AS orig_lang,
    CASE WHEN p_partkey % 5 = 0 THEN 'US' ELSE source END AS country,
    CASE WHEN p_partkey % 17 <> 0 THEN CASE WHEN p_partkey % 13 = 0 THEN 0.0 ELSE p_retailprice * 100 END END AS budget_x,
    CASE WHEN p_partkey % 31 <> 0 THEN CASE WHEN p_partkey % 11 = 0 THEN 0.0 ELSE CAST(cents AS DOUBLE) / 100 END END AS revenue,
    CAST(60 + p_partkey % 41 AS DOUBLE) AS quality_fixed
  FROM part LEFT JOIN li ON l_partkey = p_partkey LEFT JOIN documents ON doc_id = p_partkey)"""
_KEPT = """kept AS (
  SELECT * EXCLUDE (date_x), CAST(year(try_strptime(trim(date_x), '%m/%d/%Y')) AS INTEGER) AS year
  FROM raw WHERE score IS NOT NULL)"""
_CLEAN = """clean AS (
  SELECT item_id, names, year, score, coalesce(genre, 'Unknown') AS genre, coalesce(overview, 'Unknown') AS overview,
    coalesce(crew, 'Unknown') AS crew, coalesce(orig_lang, 'Unknown') AS orig_lang,
    coalesce(country, 'Unknown') AS country,
    coalesce(budget_x, (SELECT quantile_cont(budget_x, 0.5) FROM kept)) AS budget_x,
    coalesce(revenue, (SELECT quantile_cont(revenue, 0.5) FROM kept)) AS revenue, quality_fixed
  FROM kept)"""
_VEC = "vec AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"

RAW_SQL = f"WITH {_LI}, {_RAW}"
CLEAN_SQL = f"WITH {_LI}, {_RAW}, {_KEPT}, {_CLEAN}"
VEC_SQL = f"WITH {_VEC}"
CLEAN_VEC_SQL = f"WITH {_LI}, {_RAW}, {_KEPT}, {_CLEAN}, {_VEC}"

_SOURCES = {"year": "date_x"}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def raw(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return raw_catalog(spark, sf_dir, ("item_id", *columns)) if columns else raw_catalog(spark, sf_dir)


def row_bound(spark: SparkSession, sf_dir: str) -> int:
    """The catalog has one row per part; counting parts reads file footers only."""
    return table(spark, sf_dir, "part").count()


def clean(spark: SparkSession, sf_dir: str, *columns: str, often: bool = False) -> DataFrame:
    """The cleaned catalog, reduced to the tables and columns asked for.

    With ``often``, for flows of many passes, the joins behind it run once and their rows are written.
    """
    wanted = ("item_id", "score", *[_SOURCES.get(c, c) for c in columns])
    source = raw_catalog(spark, sf_dir, wanted) if columns else raw_catalog(spark, sf_dir)
    if often:
        source = cut_lineage(source, "raw-catalog")
    has_amounts = {"budget_x", "revenue"} & set(source.columns)
    cleaned = clean_catalog(source, row_bound=row_bound(spark, sf_dir) if has_amounts else None)
    return cleaned.select("item_id", *columns) if columns else cleaned


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "item_id")


def rounded(name: str | Column, digits: int = 6, alias: str | None = None) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    out = F.round(column.cast("double"), digits)
    return out.alias(alias or name) if alias or isinstance(name, str) else out


def round_columns(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: rounded(F.col(n), digits) for n in names})
