"""Title lists against a plain scan."""

import random

import pytest

from shelfrank.operators.joins import resolve_titles
from shelfrank.operators.title_index import resolve_list, title_index


def plain(rows, query):
    titles = [(i, t.lower()) for i, t in rows if t is not None]
    same = [i for i, t in titles if t == query.lower()]
    return min(same or [i for i, t in titles if query and query.lower() in t], default=None)


@pytest.mark.parametrize("per_part", [50_000, 7])
def test_a_list_equals_a_plain_scan(spark, per_part):
    r = random.Random(1)
    words = ["red", "Über", "the", "a", "ring", "STAR", "of", "x", "日本", "100%", "a.b"]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 4))) if i % 17 else None) for i in range(500)]
    queries = [t for _, t in rows[:60] if t] + ["ring", "RE", "e", "über", "%", ".", "absent", "red ring of", "日", "", "ar o"]
    catalog = spark.createDataFrame(rows, "item_id long, names string")
    asked = spark.createDataFrame([(q,) for q in queries] + [("ring",), (None,)], "query string")
    got = {x["query"]: x["item_id"] for x in resolve_list(title_index(catalog), asked, postings_per_part=per_part).collect()}
    assert got.pop(None) is None
    assert got == {q: plain(rows, q) for q in queries}


def test_a_list_equals_single_lookups(spark):
    catalog = spark.createDataFrame([(3, "Star Ring"), (1, "Ring"), (2, "ring"), (5, "Starring")], "item_id long, names string")
    titles = ["RING", "star", "starr", "none"]
    one_by_one = {r["query"]: r["item_id"] for r in resolve_titles(catalog, titles).collect()}
    listed = resolve_list(title_index(catalog), spark.createDataFrame([(t,) for t in titles], "query string"))
    assert {r["query"]: r["item_id"] for r in listed.collect()} == one_by_one


def test_many_titles_take_one_pass_without_cross_joins(spark):
    catalog = spark.range(20_000).selectExpr("id AS item_id", "concat('title number ', hex(id * 7919)) AS names")
    asked = catalog.selectExpr("substring(names, 10, 12) AS query")
    found = resolve_list(title_index(catalog), asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert found.where("item_id IS NULL").count() == 0


def test_empty_tables(spark):
    catalog = spark.createDataFrame([], "item_id long, names string")
    assert resolve_list(title_index(catalog), spark.createDataFrame([("a",)], "query string")).collect()[0]["item_id"] is None
    assert resolve_list(title_index(catalog), spark.createDataFrame([], "query string")).collect() == []
