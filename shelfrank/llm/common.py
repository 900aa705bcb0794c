"""Helpers shared by the operators: picking columns by exact name, and tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.scale import cut_lineage, shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """New name -> existing column, found by its exact spelling (the first one if it is repeated).

    Other columns may have any name, also one that differs from a wanted one only in case: they are dropped by position.
    """
    names = df.columns
    numbered = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return numbered.select(*[F.col(f"_c{names.index(old)}").alias(new) for new, old in columns.items()])


@dataclass(frozen=True)
class Numbered:
    """A table with its columns named by position, so that names that clash or differ only in case are no trouble."""

    frame: DataFrame
    names: tuple[str, ...]

    def name(self, column: str) -> str:
        """The name here of a column, found by its exact spelling (the first one if it is repeated)."""
        return f"_c{self.names.index(column)}"

    def restored(self, df: DataFrame) -> DataFrame:
        """The columns of ``df`` that came from here under their own names, and no others."""
        return df.select(*[f"_c{i}" for i in range(len(self.names))]).toDF(*self.names)


def numbered(df: DataFrame) -> Numbered:
    return Numbered(df.toDF(*[f"_c{i}" for i in range(len(df.columns))]), tuple(df.columns))


#: Spark then removes a written table's shuffle files at once: nothing reads them again, as the table stands for them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that a lost executor never repeats what made it."""
    return cut_lineage(df, purpose)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Jobs started here remove their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


#: Rows of small columns that a task gets at least, where the number of rows is known.
ROWS_IN_TASK = 50_000


def in_fewer_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df``, made from about so many rows, by as many tasks as these need and no fewer than there are cores."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, rows // ROWS_IN_TASK + 1)
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def written(df: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """As ``stored``, but the shuffle files that made the table go at once, and ``dropped`` can delete it.

    With the number of ``rows`` that it is made from, a small table does not take as many tasks and files as there are shuffle partitions.
    """
    spark = df.sparkSession
    df = df if rows is None else in_fewer_tasks(df, rows)
    path = shared_folder(spark, purpose)
    with tidy(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing will read any more; other frames are left alone."""
    for each in tables:
        path = getattr(each, "_stored_at", None)
        if path is not None:
            context = each.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def whole(text: Column) -> Column:
    """A text with null taken as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))
