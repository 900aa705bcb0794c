"""Operators that must stay exact when one key holds a large share of the rows or the data outgrows one task."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfrank import scale
from shelfrank.operators import ranking as R
from shelfrank.operators import stats as S
from shelfrank.operators.features import encode_genres
from shelfrank.operators.joins import score_by_title
from shelfrank.operators.quality import split_sets, split_sizes
from shelfrank.operators.quantiles import exact_quantiles, threshold_for_smallest, values_at_ranks


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(3000, 7.5), np.full(2000, 8.0), rng.normal(8, 20, 4000), [np.nan] * 10])
    rows = [(i, None if np.isnan(v) else float(v)) for i, v in enumerate(rng.permutation(values))]
    return spark.createDataFrame(rows, "item_id bigint, x double"), np.array([v for _, v in rows if v is not None])


def test_narrowing_finds_exact_quantiles(numbers):
    df, values = numbers
    shares = [0.0, 0.01, 0.25, 0.4, 0.5, 0.75, 0.99, 1.0]
    narrowed = exact_quantiles(df, ["x"], shares, exact_rows=50)["x"]
    np.testing.assert_allclose(narrowed, np.quantile(values, shares), rtol=1e-12)
    np.testing.assert_allclose(exact_quantiles(df, ["x"], shares)["x"], np.quantile(values, shares), rtol=1e-12)


def test_both_ways_give_the_same_bits(spark):
    rng = np.random.default_rng(6)
    rows = [tuple(float(v) for v in rng.normal(3, 9, 4)) for _ in range(3001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    shares = [0.1, 0.37, 0.5, 0.75]
    assert exact_quantiles(df, list("abcd"), shares, exact_rows=40) == exact_quantiles(df, list("abcd"), shares)


def test_values_at_ranks_of_large_integers(spark):
    base = 1 << 59
    df = spark.range(4000).select((F.lit(base) + F.pmod(F.col("id") * 7919, F.lit(4000))).alias("v"))
    assert values_at_ranks(df, "v", [0, 1999, 3999], exact_rows=100) == {0: base, 1999: base + 1999, 3999: base + 3999}
    assert threshold_for_smallest(df, "v", [10, 4000], 4000) == [base + 10, None]


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": [None]}
    assert exact_quantiles(df, ["x"], [0.5], row_bound=1) == {"x": [None]}


def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(3000).select(F.col("id").alias("item_id"), key.alias("names"))


def test_salted_join_equals_plain_join(spark):
    rows = skewed(spark)
    lookup = rows.where("names is not null").groupBy("names").agg(F.max("item_id").alias("last"))
    for how in ("left", "inner"):
        salted = scale.salted_lookup_join(rows, lookup, "names", "item_id", how)
        plain = rows.join(lookup, "names", how)
        assert sorted(map(tuple, salted.select("item_id", "names", "last").collect()), key=str) == sorted(
            map(tuple, plain.select("item_id", "names", "last").collect()), key=str
        )


def test_repeated_titles_counts_missing_titles_as_equal(spark):
    rows = skewed(spark)
    expected = {r["names"]: r["n"] for r in rows.groupBy("names").agg(F.count("*").alias("n")).collect() if r["n"] > 1}
    found = S.repeated_titles(rows).groupBy("names").agg(F.count("*").alias("n"), F.min("title_rows").alias("a"), F.max("title_rows").alias("b")).collect()
    assert {r["names"]: r["n"] for r in found} == expected
    assert all(r["a"] == r["b"] == r["n"] for r in found)


def test_last_duplicate_title_gives_the_score(spark):
    items = spark.createDataFrame([(1, "A ", 5.0), (2, "a", 9.0), (3, "b", 1.0)], "item_id bigint, names string, s double")
    rows = spark.createDataFrame([(10, "A"), (11, "B "), (12, "none"), (13, None)], "item_id bigint, names string")
    out = {r["item_id"]: r["s"] for r in score_by_title(rows, items, "s").collect()}
    assert out == {10: 9.0, 11: 1.0, 12: 0.0, 13: 0.0}


def test_top_k_per_group_with_a_hot_group(spark):
    df = skewed(spark).withColumn("v", F.pmod(F.col("item_id") * 31, F.lit(97)))
    order = [F.col("v").desc(), F.col("item_id")]
    for salts in (1, 16):
        top = scale.top_k_per_group(df, ["names"], order, 4, "item_id", salts=salts).collect()
        expected = {}
        for row in sorted(df.collect(), key=lambda r: (-r["v"], r["item_id"])):
            expected.setdefault(row["names"], []).append(row["item_id"])
        found = {}
        for row in sorted(top, key=lambda r: r["rank"]):
            found.setdefault(row["names"], []).append(row["item_id"])
        assert found == {k: v[:4] for k, v in expected.items()}


def test_small_sides_are_proven(spark):
    df = spark.range(100).withColumnRenamed("id", "item_id")
    few = spark.range(5).withColumnRenamed("id", "item_id")
    for limit in (3, 10):
        assert scale.join_small(df, few, max_rows=limit).count() == 5
        assert scale.join_small(df, few, how="left_semi", max_rows=limit).count() == 5
        assert df.join(scale.broadcast_if_small(few, limit), "item_id").count() == 5
    with pytest.raises(ValueError, match="more than 3 rows"):
        scale.collect_bounded(few, 3, "list")


def test_row_index_is_dense_and_ordered(spark):
    ids = [int(x) for x in np.random.default_rng(1).choice(10**12, 2000, replace=False)]
    df = spark.createDataFrame([(i,) for i in ids], "item_id bigint").repartition(7)
    rows = R.with_row_index(df, buckets=20).collect()
    assert {r["item_id"]: r["row_index"] for r in rows} == {v: i for i, v in enumerate(sorted(ids))}


def test_random_pairs_draw_every_pair_once(spark):
    df = spark.range(10, 60).withColumnRenamed("id", "item_id")
    pairs = R.random_pairs(df, 500, 3).collect()
    assert len({p["pair_id"] for p in pairs}) == 500
    assert all(10 <= p["id_a"] < 60 and 10 <= p["id_b"] < 60 for p in pairs)
    assert len({p["id_a"] for p in pairs}) > 40


def test_split_sizes_and_repeatability(spark):
    df = spark.range(1001).withColumnRenamed("id", "item_id")
    first = {r["item_id"]: r["set"] for r in split_sets(df).collect()}
    again = {r["item_id"]: r["set"] for r in split_sets(df.repartition(5)).collect()}
    counts = [list(first.values()).count(s) for s in ("train", "val", "test")]
    assert first == again and counts == split_sizes(1001, [0.7, 0.15, 0.15]) == [699, 151, 151]


class _Session:
    """Just the parts of a session that say where the shared folder is."""

    def __init__(self, folder, master):
        self.conf = {} if folder is None else {"spark.checkpoint.dir": folder}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_follows_the_session():
    assert scale.shared_folder(_Session("hdfs://shared/", "yarn"), "x").startswith("hdfs://shared/x-")
    assert scale.shared_folder(_Session(None, "local[2]"), "x") != scale.shared_folder(_Session(None, "local[2]"), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scale.shared_folder(_Session(None, "yarn"), "x")


def test_genre_flags_build_no_hash_sets(spark):
    """A hash set for each genre and item took most of the time of a feature matrix."""
    listed = spark.createDataFrame([(1, "A, B.c"), (2, "B c"), (3, None), (4, "")], "item_id long, genre string")
    encoded = encode_genres(listed, ["A", "B.c", "B c", "Unknown"])
    assert "arrays_overlap" not in encoded._jdf.queryExecution().toString()
    found = {r["item_id"]: tuple(r)[3:] for r in encoded.collect()}
    assert found == {1: (2, 1, 1, 0), 2: (1, 0, 1, 0), 3: (1, 0, 0, 1), 4: (1, 0, 0, 0)}
