"""Typing, missing-value handling and the clean-catalog flow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfrank.functions.numbers import finite, to_number
from shelfrank.functions.text import UNKNOWN, strip
from shelfrank.operators.quantiles import exact_quantiles

NUMERIC = ("score", "budget_x", "revenue")
IMPUTED = ("budget_x", "revenue")
CATEGORIES = ("genre", "orig_lang", "country", "overview", "crew")
DROPPED = ("date_x", "status", "orig_title")


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def drop_missing_target(df: DataFrame, target: str = "score") -> DataFrame:
    """Rows with a target; the null test is written out because it can be moved to the scan."""
    column = F.col(target)
    kept = column.isNotNull()
    if isinstance(df.schema[target].dataType, T.FractionalType):
        kept = kept & ~F.isnan(column)
    return df.where(kept)


def coerce_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC) -> DataFrame:
    """Text that is not a number becomes NULL; numeric columns become DOUBLE without NaN."""
    def typed(name: str):
        column = F.col(name)
        if isinstance(df.schema[name].dataType, T.StringType):
            return to_number(column)
        return F.nanvl(column.cast("double"), F.lit(None).cast("double"))

    return df.withColumns({name: typed(name) for name in present(df, columns)})


def parse_date(df: DataFrame, column: str = "date_x") -> DataFrame:
    """Stripped month/day/year text to DATE; anything else becomes NULL."""
    return df.withColumn(column, F.try_to_date(strip(F.col(column)), "M/d/yyyy"))


def replace_date_by_year(df: DataFrame, column: str = "date_x", year: str = "year") -> DataFrame:
    """``year`` takes the place of the date column."""
    return df.select(*[F.year(c).alias(year) if c == column else F.col(c) for c in df.columns])


def drop_if_present(df: DataFrame, columns: Sequence[str] = DROPPED) -> DataFrame:
    return df.drop(*columns)


def fit_medians(
    df: DataFrame, columns: Sequence[str] = IMPUTED, row_bound: int | None = None
) -> dict[str, float | None]:
    """Exact interpolated medians; keep the result to treat new rows like the fitted ones."""
    names = present(df, columns)
    return {name: values[0] for name, values in exact_quantiles(df, names, [0.5], row_bound=row_bound).items()}


def fill_medians(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    known = {name: value for name, value in medians.items() if value is not None}
    return df.withColumns({n: F.coalesce(F.col(n).cast("double"), F.lit(v)) for n, v in known.items()})


def fill_categories(df: DataFrame, columns: Sequence[str] = CATEGORIES, value: str = UNKNOWN) -> DataFrame:
    return df.fillna(value, subset=present(df, columns))


def infinity_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: finite(F.col(name)) for name in columns})


def zero_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def clean_catalog(
    raw: DataFrame,
    medians: Mapping[str, float | None] | None = None,
    drop_uncoercible: bool = False,
    row_bound: int | None = None,
) -> DataFrame:
    """The whole cleaning flow.

    Rows without a target go first, before typing, so a target that is text but not a number stays as NULL unless
    ``drop_uncoercible``.  ``medians`` from an earlier fit skip the fitting job.
    """
    typed = coerce_numeric(drop_missing_target(raw))
    if drop_uncoercible:
        typed = drop_missing_target(typed)
    if "date_x" in typed.columns:
        typed = replace_date_by_year(parse_date(typed))
    typed = drop_if_present(typed)
    if medians is None:
        medians = fit_medians(typed, row_bound=row_bound)
    return fill_categories(fill_medians(typed, medians))
