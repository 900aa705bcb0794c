"""Every query with a SQL text must agree with DuckDB at the smallest scale; plans must stay free of cross joins."""

import ast
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, duckdb_tables
from workload.model_queries import matrix

CHEAP_WITHOUT_SQL = ("embed_text", "semantic_index", "describe_query", "pca_2d", "quality_scores", "model_roundtrip")


@pytest.fixture(scope="module")
def duck(small):
    return duckdb_tables(small)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_agrees_with_sql(spark, duck, small, name):
    assert compare(spark, duck, small, name) == ""


@pytest.mark.parametrize("name", CHEAP_WITHOUT_SQL)
def test_returns_rows(spark, duck, small, name):
    assert compare(spark, duck, small, name) == ""


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize(
    "name", ["clean_catalog", "repeated_titles", "score_lookup_join", "histogram", "batch_similar", "hybrid_recommend", "random_pairs"]
)
def test_no_cross_join(spark, small, name):
    plan = queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark, small):
    plan = queries()["year_counts"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    assert "documents" not in plan


@pytest.mark.parametrize("path", sorted(Path(__file__).resolve().parents[1].glob("workload/*.py")), ids=lambda p: p.stem)
def test_imports_do_not_hide_each_other(path):
    """Two modules under one short name leave the queries of the first without their functions."""
    names = [a.asname or a.name for node in ast.parse(path.read_text()).body if isinstance(node, (ast.Import, ast.ImportFrom)) for a in node.names]
    assert sorted(names) == sorted(set(names))


def test_forest_levels_tries_every_one_of_many_values(spark, duck, tmp_path):
    """More values than bins of two bytes hold."""
    duck.execute(f"""COPY (SELECT i AS p_partkey, 'a' AS p_name, (hash(i) % 50)::INTEGER AS p_size, 'b' AS p_type, 'c' AS p_brand, 900.0 + i % 1000 AS p_retailprice
      FROM range(80000) t(i)) TO '{tmp_path}/part.parquet'""")
    duck.execute(f"""COPY (SELECT i AS l_partkey, i % 7 AS l_suppkey, (hash(i + 1000000) % 900000000 / 100.0)::DOUBLE AS l_extendedprice, 0.0::DOUBLE AS l_discount,
      TIMESTAMP '1995-01-01' AS l_shipdate FROM range(80000) t(i)) TO '{tmp_path}/lineitem.parquet'""")
    duck.execute(f"COPY (SELECT * FROM documents LIMIT 0) TO '{tmp_path}/documents.parquet'")
    assert compare(spark, duckdb_tables(str(tmp_path)), str(tmp_path), "forest_levels") == ""


def test_flows_of_many_passes_run_the_joins_once(spark, small):
    data, _ = matrix(spark, small)
    assert "lineitem" not in data._jdf.queryExecution().executedPlan().toString()
