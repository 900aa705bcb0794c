"""Exact order statistics whose memory need does not grow with the data.

``percentile`` and ``median`` keep every distinct value of a group in one task.  That is fine for tables of proven size
only.  For larger ones a bracket around each wanted rank is narrowed with ``approxQuantile``, whose rank error is
bounded, and exact counts; only the few values left inside the bracket are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from shelfrank.scale import cut_lineage

EXACT_ROWS = 200_000
RANK_ERROR = 0.001


@dataclass(frozen=True)
class _Bracket:
    """Open value range, or a single value when both ends agree; ``below`` rows lie under it, ``inside`` rows in it."""

    low: float | None
    high: float | None
    below: int
    inside: int

    @property
    def is_point(self) -> bool:
        return self.low is not None and self.low == self.high

    def condition(self, column: str) -> Column:
        value = F.col(column).cast("double")
        if self.is_point:
            return value == self.low
        inside = F.col(column).isNotNull()
        if self.low is not None:
            inside = inside & (value > self.low)
        if self.high is not None:
            inside = inside & (value < self.high)
        return inside

    def holds(self, rank: int) -> bool:
        return self.below <= rank < self.below + self.inside


def _parts_around(bracket: _Bracket, low: float, high: float, counts: Sequence[int]) -> list[_Bracket]:
    """The bracket cut at two values; the parts follow each other in value order, so one of them holds any rank of the whole."""
    edges = [(bracket.low, low), (low, low)]
    if low != high:
        edges += [(low, high), (high, high)]
    edges += [(high, bracket.high)]
    sizes = [*counts[:2], *(counts[2:4] if low != high else ()), counts[4]]
    below, parts = bracket.below, []
    for (start, end), size in zip(edges, sizes, strict=True):
        parts.append(_Bracket(start, end, below, size))
        below += size
    return parts


def _narrow_all(data: DataFrame, brackets: dict[tuple[str, int], _Bracket], exact_rows: int) -> bool:
    """One round for all columns and ranks together: approximate quantiles inside each large bracket, then exact counts.

    False when no bracket is left that holds more than ``exact_rows`` rows.
    """
    large = {k: b for k, b in brackets.items() if b.inside > exact_rows and not b.is_point}
    if not large:
        return False
    inner = list(dict.fromkeys((column, b) for (column, _), b in large.items()))
    values = [F.when(b.condition(c), F.col(c).cast("double")).alias(f"v{i}") for i, (c, b) in enumerate(inner)]
    places = {k: (k[1] - b.below) / max(b.inside - 1, 1) for k, b in large.items()}
    around = {k: (max(p - 2 * RANK_ERROR, 0.0), min(p + 2 * RANK_ERROR, 1.0)) for k, p in places.items()}
    shares = sorted({s for pair in around.values() for s in pair})
    found = data.select(*values).approxQuantile([f"v{i}" for i in range(len(inner))], shares, RANK_ERROR)
    cuts = {k: tuple(found[inner.index((k[0], b))][shares.index(s)] for s in around[k]) for k, b in large.items()}
    counts = []
    for i, (k, (low, high)) in enumerate(cuts.items()):
        value, inside = F.col(k[0]).cast("double"), large[k].condition(k[0])
        tests = (value < low, value == low, (value > low) & (value < high), value == high, value > high)
        counts += [F.count_if(inside & test).alias(f"n{i}_{j}") for j, test in enumerate(tests)]
    row = data.agg(*counts).first()
    for i, (k, (low, high)) in enumerate(cuts.items()):
        parts = _parts_around(large[k], low, high, [row[f"n{i}_{j}"] for j in range(5)])
        brackets[k] = next(p for p in parts if p.holds(k[1]))
    return True


def _select(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], totals: Mapping[str, int], exact_rows: int
) -> dict[tuple[str, int], float]:
    """Values at 0-based ascending ranks, for several columns in the same few passes over their written copy."""
    brackets: dict[tuple[str, int], _Bracket] = {}
    for column, ranks in wanted.items():
        for rank in ranks:
            if not 0 <= rank < totals[column]:
                raise ValueError(f"rank {rank} is outside 0..{totals[column] - 1}")
            brackets[column, rank] = _Bracket(None, None, 0, totals[column])
    if not brackets:
        return {}
    data = df.select(*wanted)
    if max(totals[c] for c in wanted) > exact_rows:
        data = cut_lineage(data, "quantiles")
        while _narrow_all(data, brackets, exact_rows):
            pass
    inner = list(dict.fromkeys((column, b) for (column, _), b in brackets.items()))
    whole = {c for c in wanted if isinstance(data.schema[c].dataType, IntegralType)}
    entries = [
        F.when(
            b.condition(c),
            F.struct(
                F.lit(i).alias("b"),
                F.col(c).cast("double").alias("v"),
                (F.col(c).cast("long") if c in whole else F.lit(None).cast("long")).alias("w"),
            ),
        )
        for i, (c, b) in enumerate(inner)
    ]
    counts = data.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL").groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    # A task sorts the distinct values of a bracket; their number is bounded by the bracket.
    upto = F.sum("n").over(Window.partitionBy("e.b").orderBy("e.v", "e.w"))
    below = F.element_at(F.array(*[F.lit(b.below).cast("long") for _, b in inner]), F.col("e.b") + 1)
    ranks = F.array(*[F.array(*[F.lit(r).cast("long") for (c, r), at in brackets.items() if (c, at) == key]) for key in inner])
    located = counts.withColumn("upto", upto + below).withColumn("from", F.col("upto") - F.col("n"))
    hits = (
        located.withColumn("rank", F.explode(F.element_at(ranks, F.col("e.b") + 1)))
        .where((F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("upto")))
        .select("e.b", "e.v", "e.w", "rank")
        .collect()
    )
    return {(inner[h["b"]][0], h["rank"]): h["v"] if h["w"] is None else h["w"] for h in hits}


def values_at_ranks(
    df: DataFrame, column: str, ranks: Sequence[int], exact_rows: int = EXACT_ROWS, total: int | None = None
) -> dict[int, float]:
    """Non-null values of ``column`` at these 0-based ascending ranks."""
    if total is None:
        total = df.agg(F.count(column)).first()[0]
    found = _select(df, {column: sorted(set(ranks))}, {column: total}, exact_rows)
    return {rank: value for (_, rank), value in found.items()}


def interpolate(low: float, high: float, position: float) -> float:
    """Between two neighbouring ranks, by the formula that Spark's ``percentile`` uses, so both ways agree to the last bit."""
    below, above = math.floor(position), math.ceil(position)
    return low if below == above or low == high else (above - position) * low + (position - below) * high


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    exact_rows: int = EXACT_ROWS,
    row_bound: int | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the non-null values, per column.

    ``row_bound`` is a known upper bound of the row count; a small one saves the counting job.
    """
    columns = list(columns)
    if not columns:
        return {}
    counts: Mapping[str, int] | None = None
    if row_bound is None or row_bound > exact_rows:
        counts = df.agg(*[F.count(name).alias(name) for name in columns]).first().asDict()
        row_bound = max(counts.values())
    if row_bound <= exact_rows:
        shares = F.array(*[F.lit(float(p)) for p in probabilities])
        row = df.agg(*[F.percentile(F.col(name).cast("double"), shares).alias(name) for name in columns]).first()
        return {n: list(row[n]) if row[n] is not None else [None] * len(probabilities) for n in columns}
    positions = {n: [p * (counts[n] - 1) for p in probabilities] if counts[n] else [] for n in columns}
    ranks = {n: sorted({r for x in xs for r in (math.floor(x), math.ceil(x))}) for n, xs in positions.items() if xs}
    values = _select(df, ranks, counts, exact_rows)

    def at(name: str, x: float) -> float:
        return interpolate(float(values[name, math.floor(x)]), float(values[name, math.ceil(x)]), x)

    return {n: [at(n, x) for x in xs] or [None] * len(probabilities) for n, xs in positions.items()}


def quantile_columns(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    exact_rows: int = EXACT_ROWS,
    row_bound: int | None = None,
) -> dict[str, Column]:
    """Array columns of exact quantiles, for use inside ``df.agg`` next to other figures.

    A table proven small is aggregated in that same pass; otherwise the values are found first and enter as literals.
    """
    if row_bound is not None and row_bound <= exact_rows:
        shares = F.array(*[F.lit(float(p)) for p in probabilities])
        return {name: F.percentile(F.col(name).cast("double"), shares) for name in columns}
    found = exact_quantiles(df, columns, probabilities, exact_rows, row_bound)
    return {name: F.array(*[F.lit(v).cast("double") for v in values]) for name, values in found.items()}


def threshold_for_smallest(df: DataFrame, column: str, counts: Sequence[int], total: int) -> list[int | None]:
    """For each ``n``, the value below which exactly ``n`` rows lie, given unique values; None when all rows do."""
    inside = sorted({n for n in counts if n < total})
    values = values_at_ranks(df, column, inside, total=total) if inside else {}
    return [values.get(n) for n in counts]
