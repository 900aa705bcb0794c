"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score bands, right-closed.
SCORE_BANDS = (
    (0, 40, "Low (0-40)"),
    (40, 60, "Medium (40-60)"),
    (60, 80, "Good (60-80)"),
    (80, 100, "Excellent (80-100)"),
)

PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(text: Column) -> Column:
    """Text to DOUBLE; anything that is not a plain decimal number becomes NULL."""
    return F.when(text.rlike(PLAIN_NUMBER), F.trim(text).try_cast("double"))


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL."""
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)


def score_band(score: Column) -> Column:
    """Label of the right-closed band; 0 and values above 100 have none."""
    chain = None
    for low, high, label in SCORE_BANDS:
        inside = (score > low) & (score <= high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def return_on_investment(revenue: Column, budget: Column) -> Column:
    """Percent; NULL when the budget is zero or missing."""
    return F.try_divide(revenue - budget, budget) * 100


def log10_positive(value: Column) -> Column:
    return F.when(value > 0, F.log10(value))


def clip(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    # greatest/least skip NULL, so a missing value must be kept missing explicitly.
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def hash60(*parts: Column | str) -> Column:
    """A repeatable 60-bit number from the text of ``parts`` joined by ``-``: the first 15 hex digits of its MD5."""
    text = F.concat_ws("-", *[F.col(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
