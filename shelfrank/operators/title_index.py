"""Search of long lists of titles: posting lists of short letter runs, joined by the rarest run of each query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.scale import broadcast_if_small

RUN = 3
POSTINGS_PER_PART = 50_000


def _runs(text: Column, size: int) -> Column:
    """The different runs of ``size`` letters; none of a shorter text."""
    places = F.sequence(F.lit(1), F.length(text) - (size - 1))
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(size)))))


def title_index(catalog: DataFrame, name: str = "names") -> DataFrame:
    """Postings ``run, title, item_id``: each different title, lower-cased and with its first item, under all its runs of one to three letters.

    A title of many items is one posting a run.  Items without a title are not in it.  The table can be stored and used for many lists.
    """
    titles = catalog.where(F.col(name).isNotNull()).groupBy(F.lower(name).alias("title")).agg(F.min("item_id").alias("item_id"))
    runs = F.concat(*[F.coalesce(_runs(F.col("title"), n), F.array().cast("array<string>")) for n in range(1, RUN + 1)])
    # An empty title has the empty run alone.
    runs = F.when(F.col("title") == "", F.array(F.lit(""))).otherwise(runs)
    return titles.select(F.explode(runs).alias("run"), "title", "item_id")


def resolve_list(index: DataFrame, queries: DataFrame, query: str = "query", postings_per_part: int = POSTINGS_PER_PART) -> DataFrame:
    """``query, item_id`` for each different query: the first item whose title equals it but for case, else the first whose title holds it, else null.

    A title that holds a query is in the posting list of the query's rarest run, so only that list is joined, and each hit is checked letter by
    letter.  Lists of more than ``postings_per_part`` titles are dealt to several parts, to which their queries go once each.  Any number of
    queries takes one pass.  An empty query finds an empty title only, a null one nothing.
    """
    asked = queries.select(F.col(query).alias("query")).distinct().withColumn("wanted", F.lower("query"))
    runs = F.coalesce(_runs(F.col("wanted"), RUN), _runs(F.col("wanted"), 2), _runs(F.col("wanted"), 1), F.when(F.col("wanted") == "", F.array(F.lit(""))))
    sizes = index.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    listed = asked.select("query", "wanted", F.explode(runs).alias("run"))
    rarest = listed.join(sizes, "run", "left").groupBy("query", "wanted").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("best"))
    chosen = rarest.where("best.n > 0").select(
        "query", "wanted", F.col("best.run").alias("run"), F.ceil(F.col("best.n") / postings_per_part).cast("int").alias("parts")
    )
    lists = broadcast_if_small(chosen.select("run", "parts").distinct())
    postings = index.join(lists, "run").withColumn("part", F.pmod(F.xxhash64("title"), F.col("parts")).cast("int"))
    spread = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    hits = spread.drop("parts").join(postings.drop("parts"), ["run", "part"]).where(F.contains("title", "wanted"))
    same = F.min(F.when(F.col("title") == F.col("wanted"), F.col("item_id")))
    found = hits.groupBy("query").agg(F.coalesce(same, F.min("item_id")).alias("item_id"))
    return asked.select("query").join(found, "query", "left")
