"""A raw item catalog derived from the TPC-H-like tables, used by the registered queries.

One row per part.  Prices, dates and amounts come from its lineitems, texts from the document with the same key.
Some values are made missing, zero or malformed so that the cleaning operators have work to do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = (
    "item_id", "names", "date_x", "score", "genre", "overview", "crew", "orig_lang", "country", "budget_x", "revenue",
    "quality_fixed",
)
CREW_GROUPS = 40
FROM_LINEITEM = {"date_x", "crew", "revenue"}
FROM_DOCUMENTS = {"overview", "orig_lang", "country"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_catalog(spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """The raw catalog; only the tables that the asked columns need are read and joined."""
    wanted = set(columns)
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    if wanted & FROM_LINEITEM:
        cents = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).cast("bigint")
        crew_bit = F.expr(f"shiftleft(1L, cast(l_suppkey % {CREW_GROUPS} as int))")
        totals = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg(
                F.sum(cents).alias("cents"),
                F.min("l_shipdate").alias("first_ship"),
                # One bit per crew group: a fixed-width state however many lineitems a part has.
                F.bit_or(crew_bit).alias("crew_bits"),
            )
        )
        part = part.join(totals, "p_partkey", "left")
    if wanted & FROM_DOCUMENTS:
        documents = table(spark, sf_dir, "documents").select(
            F.col("doc_id").alias("p_partkey"), F.col("text").alias("doc_text"), "lang", "source"
        )
        part = part.join(documents, "p_partkey", "left")

    def null_when_divisible(divisor: int, value):
        return F.when(key % divisor != 0, value)

    expressions = {
        "item_id": key,
        "names": F.col("p_name"),
        "date_x": F.when(key % 23 == 0, "n/a").otherwise(F.date_format("first_ship", "MM/dd/yyyy")),
        "score": null_when_divisible(29, F.col("p_size").cast("double") * 2),
        "genre": null_when_divisible(19, F.concat_ws(", ", "p_type", "p_brand")),
        "overview": F.col("doc_text"),
        "crew": F.expr(
            f"array_join(transform(filter(sequence(0, {CREW_GROUPS - 1}), i -> shiftright(crew_bits, i) & 1L = 1L),"
            " i -> concat('Crew ', i)), ', ')"
        ),
        "orig_lang": F.when(F.col("lang") == "en", "English").otherwise(F.col("lang")),
        "country": F.when(key % 5 == 0, "US").otherwise(F.col("source")),
        "budget_x": null_when_divisible(
            17, F.when(key % 13 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice") * 100)
        ),
        "revenue": null_when_divisible(
            31, F.when(key % 11 == 0, F.lit(0.0)).otherwise(F.col("cents").cast("double") / 100)
        ),
        "quality_fixed": (60 + key % 41).cast("double"),
    }

    return part.select(*[expressions[name].alias(name) for name in COLUMNS if name in wanted])
