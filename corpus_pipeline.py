"""The corpus pipeline: quality, near-duplicates, benchmark leaks, secrets, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfrank.llm.bpe import encode_documents
from shelfrank.llm.common import pick, stored, table
from shelfrank.llm.decontamination import drop_contaminated
from shelfrank.llm.jaccard_join import one_per_component
from shelfrank.llm.quality_votes import fit_votes, keep_good
from shelfrank.llm.secret_scan import redact_secrets

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "word_bpe_49k.json"


def documents(docs: DataFrame) -> DataFrame:
    """The columns of documents and no others."""
    return pick(docs, **{c: c for c in COLUMNS})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among them."""
    docs = documents(docs)
    return keep_good(docs, fit_votes(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return one_per_component(documents(docs))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(documents(docs), table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a placeholder."""
    return redact_secrets(documents(docs), size_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    return encode_documents(documents(docs), public_tokenizers.path(TOKENIZER), decoded=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("secrets", secrets),
    ("tokens", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
