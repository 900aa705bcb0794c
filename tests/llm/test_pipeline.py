"""The registered queries against DuckDB, and the pipeline against a plain version of its stages."""

import re

import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from check_queries import compare, duckdb_tables
from shelfrank.llm.decontamination import brute_matches
from shelfrank.llm.quality_votes import fit_votes
from shelfrank.llm.registry import ORACLES, QUERIES
from shelfrank.llm.text_shape import shape_terms

from .test_methods import LIBRARY, brute_components

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert compare(spark, duckdb_tables(SMALL), SMALL, name) == ""


def test_all_thirteen_are_registered():
    assert {re.match(r"op(\d+)_", n)[1] for n in QUERIES} == {str(i) for i in range(1, 14)}
    assert "pipeline" in queries()


def test_pipeline_equals_its_plain_version(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_votes(docs, labels)
    kept = {i: t for i, t in rows.items() if model.score(np.stack([shape_terms(t)]))[0] >= 0.3}
    components = brute_components(list(kept.items()))
    kept = {i: t for i, t in kept.items() if components[i][1] == i}
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    held = {list(kept)[t] for t, _ in brute_matches(list(kept.values()), items)}
    kept = {i: t for i, t in kept.items() if i not in held}
    assert 0 < len(kept) < len(rows)
    found = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(found) == set(kept)
    secret = re.compile(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}|(?i:password|token)[\"']?\x20*[:=]")
    for i, text in kept.items():
        if not secret.search(text):
            assert found[i] == LIBRARY.encode(text, add_special_tokens=False).ids
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "benchmark_leaks", "secrets", "tokens"]


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
