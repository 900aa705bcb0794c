"""Small helpers that keep plans safe on skewed and very large inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 10_000
MAX_FILTER_KEYS = 1_000
HOT_SHARE = 0.001
SALTS = 64


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder the cluster shares between driver and executors.

    The base is ``spark.checkpoint.dir``.  Only a local master may fall back to the machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="shelfrank-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Rows of a table that is small by contract; a larger one is an error, never a silent cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return rows


def local_frame(spark: SparkSession, table: pa.Table, schema: T.StructType) -> DataFrame:
    """A driver-side table as a DataFrame whose size the optimizer knows."""
    return spark.createDataFrame(table, schema=schema)


def _fetch(df: DataFrame, max_rows: int) -> pa.Table | None:
    """All rows of ``df`` when there are at most ``max_rows``; one row more is asked for to find out."""
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows else None


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when it is proven to hold at most ``max_rows`` rows.

    The size is checked by fetching one row more than allowed.  A larger table is returned as it is, and the join
    that follows becomes an ordinary shuffle join.
    """
    table = _fetch(df, max_rows)
    return df if table is None else F.broadcast(local_frame(df.sparkSession, table, df.schema))


def broadcast_bounded(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    """Broadcast a table that is small by contract; a larger one is an error."""
    table = _fetch(df, max_rows)
    if table is None:
        raise ValueError(f"{what} has more than {max_rows} rows")
    return F.broadcast(local_frame(df.sparkSession, table, df.schema))


def join_small(
    big: DataFrame, small: DataFrame, key: str = "item_id", how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Keep the rows of ``big`` that match ``small``: ``how`` is ``inner`` or ``left_semi``.

    A proven small side is broadcast, and a short key list also becomes a filter on ``big``, which Spark moves to the
    scan and to the other tables ``big`` is joined from.  A larger side is joined by shuffle.
    """
    table = _fetch(small, max_rows)
    if table is None:
        return big.join(small, key, how)
    keys = set(table.column(key).to_pylist()) - {None}
    kept = big.where(F.col(key).isin(*keys)) if len(keys) <= MAX_FILTER_KEYS else big
    return kept.join(F.broadcast(local_frame(big.sparkSession, table, small.schema)), key, how)


def salted_lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    how: str = "left",
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` to a lookup that has one row per ``key``, when some keys hold a large share of ``rows``.

    A key is hot when it holds more than ``hot_share`` of the rows, so at most ``1 / hot_share`` keys can be hot and
    their list is safe to broadcast.  Rows of hot keys (and rows without a key) are spread over ``salts`` partitions
    by a hash of ``spread_by``; the matching lookup rows are repeated once per salt.
    """
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    hot = (
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > total * F.lit(hot_share))
        .select(key, F.lit(True).alias("_hot"))
    )
    hot = F.broadcast(hot)
    spread = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    left = rows.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.drop("_hot").join(right, [key, "_salt"], how).drop("_salt")


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    spread_by: str,
    rank_name: str = "rank",
    salts: int = SALTS,
) -> DataFrame:
    """First ``k`` rows of every group with their rank, also when one group holds most of the rows.

    Every group is first cut to ``k`` rows in each of ``salts`` slices, so the task that ranks a whole group sees at
    most ``k * salts`` rows of it.
    """
    within_group = Window.partitionBy(*group).orderBy(*order)
    if salts > 1:
        slice_of = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
        within_slice = Window.partitionBy(*group, "_slice").orderBy(*order)
        sliced = df.withColumn("_slice", slice_of).withColumn("_r", F.row_number().over(within_slice))
        df = sliced.where(F.col("_r") <= k).drop("_slice", "_r")
    return df.withColumn(rank_name, F.row_number().over(within_group)).where(F.col(rank_name) <= k)
