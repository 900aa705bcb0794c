"""Profiles and distribution statistics.

Reports come back as small DataFrames.  Exact quantiles use :mod:`shelfrank.operators.quantiles`; every other figure is
a partial aggregate, so no task sees more than its share of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfrank.functions.text import char_count, split_list, word_count
from shelfrank.operators.projections import any_null, is_clean_row
from shelfrank.operators.quantiles import exact_quantiles, quantile_columns
from shelfrank.scale import collect_bounded, cut_lineage, salted_lookup_join



def long_form(one_row: DataFrame, names: Sequence[str], label: str = "metric", value: str = "value") -> DataFrame:
    """One row of figures as ``(metric, value)`` rows; values as DOUBLE."""
    pairs = [F.struct(F.lit(n).alias(label), F.col(n).cast("double").alias(value)) for n in names]
    return one_row.select(F.inline(F.array(*pairs)))


def _frame(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


# Counts and shares


def _dataset_figures(df: DataFrame) -> dict[str, Column]:
    return {
        "total_items": F.count("*"),
        "total_columns": F.lit(len(df.columns)).cast("bigint"),
        "score_mean": F.avg("score"),
        "score_std": F.stddev_samp("score"),
        "score_min": F.min("score"),
        "score_max": F.max("score"),
        "missing_budget": F.count_if(F.col("budget_x").isNull()),
        "missing_revenue": F.count_if(F.col("revenue").isNull()),
        "year_min": F.min("year"),
        "year_max": F.max("year"),
    }


def dataset_stats(df: DataFrame) -> DataFrame:
    """Size, score summary, missing amounts and year range in one row."""
    return df.agg(*[figure.alias(name) for name, figure in _dataset_figures(df).items()])


def duplicate_titles(df: DataFrame, column: str = "names") -> DataFrame:
    """How many titles repeat and how many rows carry them."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(
        F.count("*").alias("duplicate_titles"), F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_title_rows")
    )


def zero_counts(df: DataFrame, columns: Sequence[str] = ("budget_x", "revenue", "score")) -> DataFrame:
    """Rows equal to zero per column, with their percentage of all rows."""
    names = [*columns, "_rows"]
    counted = df.agg(*[F.count_if(F.col(c) == 0).alias(c) for c in columns], F.count("*").alias("_rows"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("zeros"), F.col("_rows")) for c in names[:-1]]
    share = F.try_divide(F.col("zeros") * 100.0, F.col("_rows"))
    return counted.select(F.inline(F.array(*pairs))).select("column", "zeros", share.alias("percent"))


def null_counts(df: DataFrame) -> DataFrame:
    """NULL count and percentage of every column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns], F.count("*").alias("_rows"))
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls"), F.col("_rows")) for c in df.columns]
    share = F.try_divide(F.col("nulls") * 100.0, F.col("_rows"))
    return counted.select(F.inline(F.array(*pairs))).select("column", "nulls", share.alias("percent"))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, worst first."""
    return null_counts(df).where("nulls > 0").orderBy(F.col("nulls").desc(), "column")


def rows_with_any_null(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(any_null(df.columns)).alias("rows_with_any_null"))


def clean_rows(df: DataFrame) -> DataFrame:
    """Count and percentage of rows without NULLs and without zero amounts."""
    return df.agg(F.count_if(is_clean_row(df.columns)).alias("clean_items"), F.count("*").alias("_rows")).select(
        "clean_items", F.try_divide(F.col("clean_items") * 100.0, F.col("_rows")).alias("clean_percentage")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier, fully equal row."""
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def repeated_titles(df: DataFrame, column: str = "names", spread_by: str = "item_id") -> DataFrame:
    """Rows whose title occurs more than once; missing titles count as equal.  Safe for very frequent titles."""
    counts = df.groupBy(column).agg(F.count("*").alias("title_rows"))
    repeated = counts.where((F.col("title_rows") > 1) & F.col(column).isNotNull())
    titled = salted_lookup_join(df.where(F.col(column).isNotNull()), repeated, column, spread_by, how="inner")
    untitled = df.where(F.col(column).isNull()).withColumn(
        "title_rows", df.agg(F.count_if(F.col(column).isNull())).scalar()
    )
    return titled.unionByName(untitled.where("title_rows > 1"))


def schema_overview(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column."""
    counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
    pairs = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*pairs)))


# Category and group counts


def value_counts(df: DataFrame, value: Column | str, name: str) -> DataFrame:
    column = F.col(value) if isinstance(value, str) else value
    counted = df.select(column.alias(name)).where(F.col(name).isNotNull())
    return counted.groupBy(name).agg(F.count("*").alias("count"))


def list_value_counts(df: DataFrame, column: str = "genre", name: str = "genre") -> DataFrame:
    return value_counts(df, F.explode(split_list(F.col(column))), name)


def top_counts(counts: DataFrame, name: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties by value."""
    return counts.orderBy(F.col("count").desc(), name).limit(n)


def distinct_values(counts: DataFrame) -> DataFrame:
    return counts.agg(F.count("*").alias("distinct_values"))


def with_share(counts: DataFrame, total: DataFrame, name: str = "percent") -> DataFrame:
    """Percentage of all rows of ``total``, read once as a scalar instead of a window over every group."""
    rows = total.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn(name, F.try_divide(F.col("count") * 100.0, rows))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count")).orderBy(key)


def group_means(df: DataFrame, key: str, value: str = "score") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(f"{value}_mean")).orderBy(key)


def genre_mean_scores(df: DataFrame, genres: Sequence[str], score: str = "score", regex: bool = False) -> DataFrame:
    """Mean score of the rows whose genre text contains each genre, best first, flagged against the overall mean."""
    def contained(genre: Column) -> Column:
        lowered = F.lower("genre")
        return F.rlike(lowered, F.lower(genre)) if regex else lowered.contains(F.lower(genre))

    matching = F.filter(F.array(*[F.lit(g) for g in genres]), contained)
    overall = df.agg(F.avg(score)).scalar()
    return (
        df.select(F.explode(matching).alias("matched_genre"), score)
        .groupBy(F.col("matched_genre").alias("genre"))
        .agg(F.avg(score).alias("mean_score"))
        .withColumn("above_mean", (F.col("mean_score") > overall).cast("int"))
        .orderBy(F.col("mean_score").desc_nulls_last(), "genre")
    )


def arg_max_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """The group with the highest mean; ties by name."""
    means = df.groupBy(group).agg(F.avg(value).alias("mean_value"))
    return means.orderBy(F.col("mean_value").desc_nulls_last(), group).limit(1)


# Distributions


def describe(df: DataFrame, columns: Sequence[str], row_bound: int | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, min, exact quartiles and max, one row per column."""
    quartiles = quantile_columns(df, columns, [0.25, 0.5, 0.75], row_bound=row_bound)
    parts = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), quartiles[c].alias("q"), F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    rows = df.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))
    names = ("q25", "median", "q75")
    return rows.select("column", "count", "mean", "std", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(names)], "max")


def text_stats(df: DataFrame, column: str, row_bound: int | None = None) -> DataFrame:
    """Word and character counts of a text column: mean, median, min and max."""
    text = F.col(column)
    lengths = df.select(
        F.when(text.isNotNull(), word_count(text)).alias("word_count"),
        F.when(text.isNotNull(), char_count(text)).alias("char_count"),
    )
    medians = quantile_columns(lengths, ["word_count", "char_count"], [0.5], row_bound=row_bound)
    figures = [F.count("*").alias("total_descriptions")]
    for name in ("word_count", "char_count"):
        figures += [
            F.avg(name).alias(f"avg_{name}"),
            F.get(medians[name], F.lit(0)).alias(f"median_{name}"),
            F.min(name).alias(f"min_{name}"),
            F.max(name).alias(f"max_{name}"),
        ]
    return lengths.agg(*figures)


def correlation(df: DataFrame, columns: Sequence[str], upper_only: bool = False) -> DataFrame:
    """Pearson correlation of every column pair over the rows where both are present, in one aggregate."""
    pairs = [(a, b) for a, b in combinations_with_replacement(columns, 2)]
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        both = [(a, b)] if a == b or upper_only else [(a, b), (b, a)]
        if upper_only and a == b:
            continue
        entries += [
            F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias("correlation"))
            for x, y in both
        ]
    return row.select(F.inline(F.array(*entries)))


def histogram(df: DataFrame, column: str | Column, bins: int = 50) -> DataFrame:
    """Equal-width bins over the value range, the last one closed; empty bins have no row."""
    chosen = df.select((F.col(column) if isinstance(column, str) else column).alias("x"))
    values = chosen.select(F.col("x").cast("double")).where(F.col("x").isNotNull())
    span = values.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("s")).scalar()
    low, high = span["low"], span["high"]
    # A column with one value is shown the way plotting libraries do: unit range around it.
    start = F.when(low == high, low - 0.5).otherwise(low)
    width = F.when(low == high, F.lit(1.0)).otherwise(high - low) / bins
    placed = F.least(F.floor((F.col("x") - start) / width), F.lit(bins - 1)).cast("int")
    return (
        values.select(placed.alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
        .select("bin", (start + F.col("bin") * width).alias("bin_start"), "count")
    )


def boxplot_stats(df: DataFrame, column: str, row_bound: int | None = None) -> DataFrame:
    """Quartiles, whiskers at the extreme points within 1.5 interquartile ranges, and the number of outliers."""
    q1, median, q3 = exact_quantiles(df, [column], [0.25, 0.5, 0.75], row_bound=row_bound)[column]
    if q1 is None:
        return _frame(df, [], "q1 double, median double, q3 double, whisker_low double, whisker_high double, outliers bigint")
    value = F.col(column).cast("double")
    reach = 1.5 * (q3 - q1)
    low, high = q1 - reach, q3 + reach
    return df.agg(
        F.lit(float(q1)).alias("q1"),
        F.lit(float(median)).alias("median"),
        F.lit(float(q3)).alias("q3"),
        F.min(F.when(value >= low, value)).alias("whisker_low"),
        F.max(F.when(value <= high, value)).alias("whisker_high"),
        F.count_if((value < low) | (value > high)).alias("outliers"),
    )


def boxplot_outliers(df: DataFrame, column: str, row_bound: int | None = None) -> DataFrame:
    """Rows outside the whiskers."""
    q1, q3 = exact_quantiles(df, [column], [0.25, 0.75], row_bound=row_bound)[column]
    if q1 is None:
        return df.where(F.lit(False))
    reach = 1.5 * (q3 - q1)
    return df.where((F.col(column) < q1 - reach) | (F.col(column) > q3 + reach))


def density(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density on an even grid that extends half the value range to both sides.

    The bandwidth follows Scott's rule.  Every row adds to all grid points inside its own task, so only one partial
    sum per grid point and task is shuffled.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    row = values.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    n, spread = row["n"], row["s"]
    if n < 2 or not spread:
        raise ValueError("density needs at least two different values")
    bandwidth = spread * n ** (-0.2)
    reach = 0.5 * (row["high"] - row["low"])
    start, step = row["low"] - reach, (row["high"] - row["low"] + 2 * reach) / (points - 1)
    spots = F.array(*[F.lit(start + i * step) for i in range(points)])
    scaled = (F.col("x") - F.col("position")) / bandwidth
    kernel = F.exp(-scaled * scaled / 2)
    return (
        values.select("x", F.posexplode(spots).alias("point", "position"))
        .groupBy("point", "position")
        .agg((F.sum(kernel) / (n * bandwidth * (2 * 3.141592653589793) ** 0.5)).alias("density"))
    )


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


# Embeddings


def per_dimension_stats(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Mean and population standard deviation of every vector position."""
    values = df.select(F.posexplode(column).alias("dimension", "v"))
    value = F.col("v").cast("double")
    return values.groupBy("dimension").agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def embedding_stats(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Number of vectors, dimension, and mean, population standard deviation, min and max of all values."""
    values = df.select(F.posexplode(column).alias("position", "v"))
    value = F.col("v").cast("double")
    return values.agg(
        F.count_if(F.col("position") == 0).alias("count"), (F.max("position") + 1).alias("dimension"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
    )


def similarity_summary(df: DataFrame, column: str = "similarity", row_bound: int | None = None) -> DataFrame:
    """Mean, exact median, population standard deviation, min and max."""
    median = quantile_columns(df, [column], [0.5], row_bound=row_bound)[column]
    return df.agg(
        F.avg(column).alias("mean"), F.get(median, F.lit(0)).alias("median"), F.stddev_pop(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"),
    )


# Combined report


def stats_report(df: DataFrame, detailed: bool = True, top_genres: int = 5, top_categories: int = 3) -> DataFrame:
    """All profile figures as ``(section, metric, value)`` rows.

    Two passes over the data: one aggregate for every single figure, one for the counts of all titles, genres and categories.
    """
    sections = {"basic": _dataset_figures(df)}
    if detailed:
        good = F.count_if(is_clean_row(df.columns))
        zeros = {f"{c}_zero": F.count_if(F.col(c) == 0) for c in ("budget_x", "revenue", "score")}
        sections["nulls"] = {"rows_with_any_null": F.count_if(any_null(df.columns))}
        sections["quality"] = {
            "clean_items": good, "clean_percentage": F.try_divide(good * 100.0, F.count("*")), **zeros
        }
        sections["nulls_per_column"] = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    entries = [
        F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), figure.cast("double").alias("value"))
        for section, figures in sections.items()
        for metric, figure in figures.items()
    ]
    report = df.agg(F.array(*entries).alias("rows")).select(F.inline("rows"))
    if not detailed:
        return report
    limits = {"genre": top_genres, "orig_lang": top_categories, "country": top_categories}
    limits = {name: n for name, n in limits.items() if name in df.columns}
    counts = cut_lineage(tagged_counts(df, ["names", *limits]), "value-counts")
    repeated = counts.where((F.col("kind") == "names") & (F.col("count") > 1)).agg(
        F.count("*").alias("duplicate_titles"), F.coalesce(F.sum("count"), F.lit(0)).alias("duplicate_title_rows")
    )
    parts = [report, long_form(repeated, repeated.columns).withColumn("section", F.lit("duplicates"))]
    for name, n in limits.items():
        own = counts.where(F.col("kind") == name)
        value = F.col("count").cast("double").alias("value")
        top = top_counts(own, "entry", n)
        parts.append(top.select(F.lit(f"top_{name}").alias("section"), F.col("entry").alias("metric"), value))
        distinct = distinct_values(own)
        parts.append(long_form(distinct, distinct.columns).withColumn("section", F.lit(f"distinct_{name}")))
    return reduce(DataFrame.unionByName, parts)


def tagged_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows per value of several columns at once, as ``(kind, entry, count)``; genres are split."""
    def tagged(name: str) -> Column:
        entries = split_list(F.col(name)) if name == "genre" else F.array(F.col(name))
        structs = F.transform(entries, lambda e: F.struct(F.lit(name).alias("kind"), e.alias("entry")))
        return F.when(F.col(name).isNotNull(), structs).otherwise(F.array().cast("array<struct<kind:string,entry:string>>"))

    values = df.select(F.inline(F.concat(*[tagged(name) for name in names])))
    return values.groupBy("kind", "entry").agg(F.count("*").alias("count"))


def collect_top(counts: DataFrame, name: str, n: int) -> list[str]:
    """The ``n`` most frequent values as a list in the driver, as many as are asked for."""
    return [row[name] for row in collect_bounded(top_counts(counts, name, n), n, f"top {name}")]
