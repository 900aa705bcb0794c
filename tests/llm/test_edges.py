"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from shelfrank.llm.bpe import encode_documents
from shelfrank.llm.curve_search import nearest_by_curves
from shelfrank.llm.decontamination import contaminated, drop_contaminated
from shelfrank.llm.jaccard_join import jaccard_join, one_per_component
from shelfrank.llm.quality_votes import fit_votes, keep_good, score_quality
from shelfrank.llm.secret_scan import PLACEHOLDER, find_secrets, redact_secrets
from shelfrank.llm.sharding import balanced_shards
from shelfrank.llm.span_dedup import remove_repeated_spans
from shelfrank.llm.url_filter import Rule, filter_urls
from shelfrank.llm.warc import read_archives, write_archives

from .frames import PASSAGE, ROWS, documents, sorted_rows, with_clashes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (None, PASSAGE)], "item_id long, text string")


def labels(spark):
    rows = [(i, int(i % 3 > 0)) for i in range(1, 11)] + [(1, 1), (None, 1), (3, None), (4, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


def scored(df):
    return score_quality(df, fit_votes(df, labels(df.sparkSession)))


PER_ROW = {
    "quality": scored,
    "secrets": find_secrets,
    "spans": remove_repeated_spans,
    "jaccard": lambda df: jaccard_join(df).labelled("doc_id"),
    "shards": lambda df: balanced_shards(df, 3),
    "bpe": lambda df: encode_documents(df, TOKENIZER),
}
DROPPED = {"shards": ("slot",)}


@pytest.mark.parametrize("name", PER_ROW)
def test_every_row_has_a_result_whatever_other_columns_there_are(spark, name):
    plain = PER_ROW[name](documents(spark)).drop(*DROPPED.get(name, ()))
    clashing = PER_ROW[name](with_clashes(documents(spark))).drop(*DROPPED.get(name, ()))
    rows = sorted_rows(plain)
    assert len(rows) == len(ROWS)
    assert rows == sorted_rows(clashing)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(spark, name):
    assert PER_ROW[name](documents(spark, [])).collect() == []


def test_defined_results(spark):
    found = {r.doc_id: r for r in find_secrets(documents(spark)).collect() if r.doc_id}
    assert found[2].secrets == [] and found[3].secrets == []
    assert len(found[8].secrets) == 3
    shingles = {r.doc_id: r for r in PER_ROW["jaccard"](documents(spark)).collect() if r.doc_id}
    assert [shingles[i].n_shingles for i in (2, 3, 4)] == [0, 0, 0]
    assert [shingles[i].component_id for i in (1, 9, 10)] == [1, 1, 1]
    tokens = {r.doc_id: r.n_tokens for r in PER_ROW["bpe"](documents(spark)).collect() if r.doc_id}
    assert tokens[2] == tokens[3] == tokens[4] == 0 and tokens[5] > 30_000
    shards = PER_ROW["shards"](documents(spark)).collect()
    assert {r.shard for r in shards if r.doc_id in (1, 9)}.__len__() == 1
    assert {r.size for r in shards if r.doc_id in (2, 3)} == {16}


def test_decontamination(spark):
    found = contaminated(with_clashes(documents(spark)), benchmark(spark)).collect()
    assert sorted((r.doc_id, str(r.item_id), r.edits) for r in found) == sorted(2 * [(7, "1", 0), (7, "None", 0)] + [(6, "1", 0), (6, "None", 0)])
    assert contaminated(documents(spark, []), benchmark(spark)).collect() == []
    assert contaminated(documents(spark), benchmark(spark).limit(0)).collect() == []
    assert drop_contaminated(documents(spark), benchmark(spark)).count() == len(ROWS) - 3
    # Several passes over the documents find what one pass finds.
    assert len(contaminated(documents(spark), benchmark(spark), words_per_pass=10).collect()) == len(found)


def test_filters_keep_columns(spark):
    df = documents(spark).withColumn("n_chars", F.length("text")).withColumn("extra", F.lit(1))
    assert keep_good(df, fit_votes(df, labels(spark))).columns == df.columns
    kept = one_per_component(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id) == [1, 2, 3, 4, 5, 6, 8]  # 7 shares 39 of 51 sequences with 6
    assert sum(r.doc_id is None for r in rows) == 2
    cut = {r.doc_id: r for r in redact_secrets(df, size_col="n_chars").collect() if r.doc_id}
    assert "AKIA" not in cut[8].text and len(cut[8].text) == cut[8].n_chars
    assert cut[2].text is None and cut[1].text == "A plain text of some seven words here."


def test_no_labels_scores_half(spark):
    none = labels(spark).limit(0)
    assert {r.score for r in score_quality(documents(spark), fit_votes(documents(spark), none)).collect()} == {0.5}


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, ""), (None, "http://a.com/x"), (4, "http://a.com/x"), (4, "http://a.com/x"), (5, "http://" + "a." * 20_000 + "net/" + "b/" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = [Rule("block", "a.com", "/x"), Rule("allow", "a.com", "/x"), Rule("block", "net", "")]
    found = filter_urls(df, rules)
    verdicts = sorted((str(r.page_id), r.host[:5], r.rule, r.verdict) for r in found.collect())
    assert verdicts == sorted([("1", "", None, "allow"), ("2", "", None, "allow"), ("3", "", None, "allow"), ("None", "a.com", "a.com/x", "block")] + 2 * [("4", "a.com", "a.com/x", "block")] + [("5", "a.a.a", "net", "block")])
    assert sorted_rows(found) == sorted_rows(filter_urls(with_clashes(df, text="URL", number="Page_Id"), rules, max_rules=1))
    assert {r.verdict for r in filter_urls(df, [], default="block").collect()} == {"block"}
    assert filter_urls(df.limit(0), rules).collect() == []


def test_archives(spark):
    page = "<p>é" + "x" * 200
    rows = [(3, "u", page), (1, None, page), (1, "u\n2", page), (None, "u", page), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "y" * 300_000), (None, None, "z" * 100)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = read_archives(write_archives(df, archive_bytes=500), payloads=True).collect()
    assert len(found) == len(rows)
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in found)
    long = len(page.encode())
    assert got == sorted([("3", "revisit", "1", long), ("1", "response", "None", long), ("1", "response", "None", long), ("None", "revisit", "1", long), ("4", "response", "None", 0), ("5", "response", "None", 0), ("6", "response", "None", 5), ("7", "response", "None", 5), ("8", "response", "None", 300_000), ("None", "response", "None", 100)])
    assert {r.payload for r in found if r.record_type == "response"} == {page, "", "short", "y" * 300_000, "z" * 100}
    assert {r.url for r in found} == {"u", None, "u\n2"}
    assert read_archives(write_archives(df.limit(0))).collect() == []
    assert read_archives(write_archives(with_clashes(df, text="HTML", number="Page_Id"))).count() == len(rows)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [0.0, 1.0]), (7, [0.0, -1.0]), (8, None), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [0.0, 0.0]), (12, [None, 1.0]), (13, [1.0]), (None, [1.0, 1.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in nearest_by_curves(df, F.col("id") % 100 == 0, k=3).collect())
    far = round(2**0.5, 9)
    assert found == [(0, 1, 5, 0.0), (0, 2, 100, 0.0), (0, 3, 6, far), (100, 1, 0, 0.0), (100, 2, 5, 0.0), (100, 3, 6, far)]
    clashing = nearest_by_curves(with_clashes(df, text="Embedding", number="VEC_ID"), F.col("id") % 100 == 0, k=3)
    assert len(clashing.collect()) == 6
    assert nearest_by_curves(df.limit(0), F.col("id") % 100 == 0).collect() == []


CLASHING = "doc_id long, text string, TEXT string, Doc_Id long, _secrets int, _cut int, _digest int, _c0 string, n_chars long"
KEY = "password = Zk3vQ9xW2pLm8rTy"


def stage_operators(spark):
    from shelfrank.llm.decontamination import drop_contaminated
    from shelfrank.llm.jaccard_join import one_per_component
    from shelfrank.llm.quality_votes import fit_votes, keep_good
    from shelfrank.llm.secret_scan import redact_secrets

    folder = "/root/testdata/sf0.001"
    docs, labels, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    model = fit_votes(docs, labels)
    return {
        "quality": lambda df: keep_good(df, model),
        "near_duplicates": one_per_component,
        "benchmark_leaks": lambda df: drop_contaminated(df, items),
        "secrets": lambda df: redact_secrets(df, size_col="n_chars"),
    }


def test_stages_with_clashing_columns_nulls_and_repeated_rows(spark):
    texts = [None, "", " ", "one two three four five six seven", "one two three four five six seven", KEY]
    rows = [(None if i == 4 else i, t, "x", 7, 1, 2, 3, "y", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, rows[3]], CLASHING)
    for name, stage in stage_operators(spark).items():
        assert stage(df.limit(0)).collect() == [], name
        made = stage(df)
        assert made.columns == df.columns, name
        found = sorted((tuple(r) for r in made.collect()), key=str)
        if name == "near_duplicates":
            assert found == sorted([*rows[:4], rows[5]], key=str)
        elif name == "benchmark_leaks":
            assert found == sorted([*rows, rows[3]], key=str)
        elif name == "secrets":
            assert found == sorted([*rows[:5], rows[3], (5, PLACEHOLDER, *rows[5][2:8], len(PLACEHOLDER))], key=str)
        else:
            assert set(found) <= set(rows)
