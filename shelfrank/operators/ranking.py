"""Sorting, top-k, best row per key, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window

from shelfrank.functions.numbers import hash60
from shelfrank.scale import top_k_per_group

TIERS = ((0.80, "excellent"), (0.70, "good"))
INDEX_BUCKETS = 1000
MAX_BROADCAST_PAIRS = 100_000


def top_n(df: DataFrame, by: str, n: int, tie: str = "item_id") -> DataFrame:
    """The ``n`` largest rows; equal values in ``tie`` order.  Each task keeps only its own ``n`` best."""
    return df.orderBy(F.col(by).desc_nulls_last(), tie).limit(n)


def n_largest(df: DataFrame, by: str, n: int, tie: str = "item_id") -> DataFrame:
    return top_n(df.where(F.col(by).isNotNull()), by, n, tie)


def best_per_title(df: DataFrame, by: str, name: str = "names", tie: str = "item_id") -> DataFrame:
    """The best row of every title: a partial aggregate, so a frequent title costs one row per task."""
    others = [c for c in df.columns if c != name]
    best = F.max_by(F.struct(*others), F.struct(F.coalesce(F.col(by), F.lit(float("-inf"))), -F.col(tie)))
    return df.groupBy(name).agg(best.alias("_row")).select(name, "_row.*").select(*df.columns)


def strength_tier(similarity: Column) -> Column:
    (high, top), (middle, good) = TIERS
    return F.when(similarity > high, top).when(similarity > middle, good).otherwise("moderate")


def rank_of_matches(recommendations: DataFrame, pattern: str, group: Sequence[str] = ("query",)) -> DataFrame:
    """Best rank at which a title containing ``pattern`` appears in each ranked list, with its strength tier."""
    hits = recommendations.where(F.lower("names").contains(pattern.lower()))
    first = F.min_by(F.struct("names", "similarity"), "rank")
    return (
        hits.groupBy(*group)
        .agg(F.min("rank").alias("rank"), first.alias("_hit"))
        .select(*group, "rank", "_hit.names", "_hit.similarity", strength_tier(F.col("_hit.similarity")).alias("tier"))
    )


def hash_sample(df: DataFrame, n: int, seed: int, key: str = "item_id") -> DataFrame:
    """A repeatable uniform sample of ``n`` rows without replacement: the smallest hashed keys."""
    return df.withColumn("_h", hash60(key, F.lit(seed))).orderBy("_h", key).limit(n).drop("_h")


def hash_sample_per_group(df: DataFrame, group: str, n: int, seed: int, key: str = "item_id") -> DataFrame:
    hashed = df.withColumn("_h", hash60(key, F.lit(seed)))
    return top_k_per_group(hashed, [group], [F.col("_h"), F.col(key)], n, key, "_r").drop("_h", "_r")


def with_row_index(df: DataFrame, key: str = "item_id", name: str = "row_index", buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Dense 0-based position in ``key`` order without sorting everything in one task.

    The key range is cut at approximate quantiles into buckets of similar size; a row's index is its position in its
    bucket plus the sizes of the buckets before it.  Only the bounded list of cuts and the bucket sizes are small tables.
    """
    cuts = sorted(set(df.approxQuantile(key, [i / buckets for i in range(1, buckets)], 0.5 / buckets)))
    if len(cuts) < 2:
        bucketed = df.withColumn("_bucket", F.lit(0.0))
    else:
        splits = [float("-inf"), *cuts, float("inf")]
        keyed = df.withColumn("_key", F.col(key).cast("double"))
        bucketed = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket").transform(keyed).drop("_key")
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # At most one row per bucket, so the running sum over all of them is bounded.
    before = F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")
    offsets = F.broadcast(sizes.select("_bucket", before.alias("_before")))
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    return bucketed.join(offsets, "_bucket").withColumn(name, F.col("_before") + position).drop("_bucket", "_before")


def random_pairs(df: DataFrame, n_pairs: int, seed: int, key: str = "item_id") -> DataFrame:
    """``n_pairs`` repeatable random pairs of items, drawn with replacement."""
    spark = df.sparkSession
    indexed = with_row_index(df.select(key), key)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()

    def draw(side: str) -> Column:
        return F.pmod(hash60(F.col("pair_id").cast("string"), F.lit(side), F.lit(seed)), rows)

    drawn = spark.range(n_pairs).withColumnRenamed("id", "pair_id").select(
        "pair_id", draw("a").alias("index_a"), draw("b").alias("index_b")
    )
    # Both sides meet the item index at once; they have 2 * n_pairs rows, known in advance.
    sides = drawn.select(
        "pair_id",
        F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("index_a").alias("row_index")),
                          F.struct(F.lit("b").alias("side"), F.col("index_b").alias("row_index")))).alias("s"),
    ).select("pair_id", "s.*")
    found = indexed.join(F.broadcast(sides) if n_pairs <= MAX_BROADCAST_PAIRS else sides, "row_index")
    return found.groupBy("pair_id").agg(
        F.max(F.when(F.col("side") == "a", F.col(key))).alias("id_a"),
        F.max(F.when(F.col("side") == "b", F.col(key))).alias("id_b"),
    )
