"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.llm.common import dropped, written

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and the smallest node of its component, for every node of an edge between two different nodes, as a written table.

    Alternates two rewrites until nothing changes: every node links its larger neighbours to the smallest one, then its smaller
    neighbours.  Each round is two aggregations by minimum and two joins; the number of rounds grows with the logarithm of
    the longest path.  Minima are written before they are joined, so a node with very many edges is split by the join.  The tables
    of a round are deleted after the next one, and take no more tasks than their rows need.  No edges give no rows; repeated edges and edges from a node to itself change nothing.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    links = written(edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "edges", edges.count())
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        if state == (0, None):
            break
        links = _small_star(_large_star(links, state[0]), state[0])
        before, state = state, _state(links)
        if state == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    labels = links.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    out = written(labels.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components", 2 * state[0])
    dropped(links)
    return out


def _state(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), total).first())


def _large_star(links: DataFrame, rows: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima", 2 * rows)
    turned = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    out = written(turned.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges", 2 * rows)
    dropped(links, least)
    return out


def _small_star(links: DataFrame, rows: int) -> DataFrame:
    least = written(links.groupBy("u").agg(F.min("v").alias("m")), "minima", rows)
    turned = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = written(turned.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges", 2 * rows)
    dropped(links, least)
    return out
