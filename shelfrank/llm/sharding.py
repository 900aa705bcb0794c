"""Sharding: longest-processing-time scheduling of groups that must stay together."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfrank.llm.common import pick, stored, whole

BUNDLES = 65_536
UNITS_PER_SHARD = 256
ROWS_PER_BLOCK = 20_000
MIN_BLOCKS = 16


def least_loaded(sizes: Iterable[tuple[int, int]], shards: int) -> dict[int, int]:
    """unit -> shard: units (key, size) by falling size, each to the shard with the smallest load so far."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for key, size in sorted(sizes, key=lambda unit: (-unit[1], unit[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[key] = shard
    return placed


def balanced_shards(
    df: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, bundles: int = BUNDLES
) -> DataFrame:
    """Every row with its size in bytes, the CRC of its text, its shard and a gapless position in it.

    Rows with equal texts form a group that stays in one shard.  A group of at least 1 / (256 * shards) of all bytes is a
    scheduling unit of its own; there are at most 256 * shards of them, whatever the size of the table.  Smaller groups are
    first put into ``bundles`` bundles by a hash of the text.  Both numbers are fixed, so the heap in the driver handles a bounded
    list while every row is counted.  A group larger than a shard's fair share fills a shard alone, and the others share the rest.

    A null text counts as empty and joins the group of empty texts.  Repeated rows get a slot each.  Null ids are allowed.
    An empty table gives an empty result.  Other columns are ignored.
    """
    spark = df.sparkSession
    text = whole(F.col("text"))
    rows = pick(df, id=id_col, text=text_col).select(
        "id",
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("_group"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stored(rows, "shard-rows")
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    total = total or 0
    bundle = F.pmod(F.col("_group"), F.lit(bundles))
    groups = rows.groupBy("_group").agg(F.sum("size").alias("size"))
    is_large = F.col("size") * F.lit(shards * UNITS_PER_SHARD) >= F.lit(total)
    units = (
        groups.select(F.when(is_large, F.col("_group")).otherwise(bundle).alias("unit"), is_large.alias("large"), "size")
        .groupBy("large", "unit")
        .agg(F.sum("size").alias("size"))
        .toPandas()
    )
    keys = list(zip(units["large"], units["unit"], strict=True))
    placed = least_loaded(((i, size) for i, size in enumerate(units["size"])), shards)

    def places(large: bool, name: str) -> DataFrame:
        chosen = [(key, placed[i]) for i, (is_large, key) in enumerate(keys) if bool(is_large) == large]
        columns = list(zip(*chosen, strict=True)) or [(), ()]
        made = pa.table({name: pa.array(map(int, columns[0]), pa.int64()), f"{name}_shard": pa.array(columns[1], pa.int32())})
        return F.broadcast(spark.createDataFrame(made))

    shard = F.coalesce("_group_shard", "_bundle_shard")
    blocks = max(MIN_BLOCKS, count // ROWS_PER_BLOCK)
    placed_rows = (
        rows.withColumn("_bundle", bundle)
        .join(places(True, "_group"), "_group", "left")
        .join(places(False, "_bundle"), "_bundle", "left")
        .withColumn("shard", shard)
        .withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    )
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed_rows.groupBy("shard", "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("shard", "_block").orderBy("id", "_row")
    return placed_rows.join(starts, ["shard", "_block"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("_start") + F.row_number().over(inside) - 1).alias("slot"),
    )


def write_shards(df: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the rows of ``df`` below ``path``, one folder per shard; ids must be unique.  Many files make up a shard."""
    df.join(placed.select(id_col, "shard", "slot"), id_col).write.partitionBy("shard").parquet(path)
