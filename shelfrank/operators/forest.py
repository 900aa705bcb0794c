"""Regression forests grown from histograms: minimum rows to split and in a leaf, and whole parameter grids from shared growths."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfrank.functions.numbers import hash60
from shelfrank.operators.quality import METRICS, fold_of, metrics_by_set, split_sets
from shelfrank.scale import cut_lineage

# The settings of the forest and of its grid.
FOREST_DEFAULTS = {"trees": 100, "depth": 15, "min_split": 10, "min_leaf": 1}
FULL_GRID = {"trees": (100, 200, 300), "depth": (10, 20, 30), "min_split": (2, 5, 10), "min_leaf": (1, 2, 4)}
MAX_BINS = 128
#: Nodes of more rows are split by histograms that all tasks add up; smaller ones are finished by the task that gets their rows.
ROWS_IN_TASK = 1_250_000
TREES_IN_BLOCK = 20
#: A growth of few trees is dealt in smaller blocks, about as many.
BLOCKS = 33
#: Small tasks, as groups differ in the time they take and their number is known.
TASKS_A_CORE = 16
#: Sums per node, column and bin that a task holds at once.
CELLS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 100_000
#: Rows whose sums a task makes at once: few enough that rows, weights and labels of up to some hundred fit into one number.
ROWS_SUMMED = 25_000
#: Nodes of so many rows keep their sums, from which those of the larger child follow; smaller ones are quickly added up.
ROWS_TO_SUBTRACT = 1_000
#: Nodes of fewer rows are split by running sums, not by sums for each bin.
ROWS_TO_SORT = 100
#: Trees that are broadcast at once, and how often rows go on before those in a leaf are left out.
NODES_AT_ONCE, STEPS_AT_ONCE = 4_000_000, 4
#: Columns of so many bins at most are read together, as long as they have so many codes in all.
NARROW, CODES = 4, 64
#: Different values of a column that are summed up in one window by ``exact_tree``.
ROWS_IN_SLICE = 50_000
HISTOGRAM_BYTES = 256 << 20
NODES = "growth int, tree int, node long, rows long, weight double, value double, gain double, feature int, bin int"
NODE_COLUMNS = tuple(c.split()[0] for c in NODES.split(", "))
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 16.0)])))


@dataclass(frozen=True)
class Growth:
    """Trees that learn from all rows outside ``fold`` (None: from all rows) with one minimum of rows in a leaf."""

    min_leaf: int
    fold: int | None = None


def bin_edges(df: DataFrame, columns: Sequence[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Ascending edges per column; a value goes left of the first edge that is not below it.

    Columns of at most ``max_bins`` different values are cut between any two, the others at quantiles.
    """
    held = _few_values(df, columns, 2 * max_bins)
    # An estimate decides where the number of values is near the limit; it is costly, and elsewhere it cannot be so far off.
    unsure = [c for c in held if len(held[c]) > max_bins // 2]
    sizes = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(c) for c in unsure]).first() if unsure else {}
    few = [c for c in held if c not in unsure or sizes[c] <= max_bins * 0.9]
    shares = [i / max_bins for i in range(1, max_bins)]
    many = [c for c in columns if c not in few]
    found = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), shares, 10_000).alias(c) for c in many]).first() if many else {}
    out = {}
    for c in columns:
        values = held[c] if c in few else sorted(set(found[c] or []))
        out[c] = [(a + b) / 2 for a, b in zip(values, values[1:])] if c in few else values
    return out


def _few_values(df: DataFrame, columns: Sequence[str], limit: int) -> dict[str, list[float]]:
    """The different values, ascending, of the columns that have at most ``limit`` of them; missing ones do not count."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [np.empty(0) for _ in columns]
        for batch in batches:
            for i, own in enumerate(held):
                if len(own) <= limit:
                    x = batch[f"x{i}"].to_numpy(float)
                    at = np.minimum(np.searchsorted(own, x), len(own) - 1)
                    fresh = x[~np.isnan(x) & (own[at] != x)] if len(own) else x[~np.isnan(x)]
                    held[i] = np.union1d(own, fresh) if len(fresh) else own
        yield pd.DataFrame({"column": range(len(columns)), "value": [own[: limit + 1] for own in held]})

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    parts = rows.mapInPandas(partial, "column int, value array<double>").select("column", F.explode("value").alias("value"))
    own = parts.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("value")).alias("values"))
    found = {r["column"]: r["values"] for r in own.select("column", F.when(F.col("n") <= limit, F.col("values")).alias("values")).collect()}
    return {c: values for i, c in enumerate(columns) if (values := found.get(i, [])) is not None}


def binned_rows(matrix: DataFrame, edges: Mapping[str, Sequence[float]], label: str = "label", key: str = "item_id", fold: str | None = None) -> DataFrame:
    """row (a hash of the key), fold, y and the bins of all columns as bytes; a missing value is in the last bin."""
    wide = np.uint8 if max((len(e) for e in edges.values()), default=0) < 256 else np.uint16
    arrays = [np.asarray(e, dtype=float) for e in edges.values()]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                bins = np.stack([np.searchsorted(e, batch[f"x{i}"].to_numpy(float)) for i, e in enumerate(arrays)], axis=1).astype(wide)
                yield pd.DataFrame({"row": batch["row"], "fold": batch["fold"], "y": batch["y"], "bins": [b.tobytes() for b in bins]})

    rows = matrix.where(F.col(label).isNotNull()).select(
        hash60(key, F.lit("forest")).alias("row"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), F.col(label).cast("double").alias("y"),
        *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(edges)],
    )
    return rows.mapInPandas(cut, "row long, fold int, y double, bins binary")


def bootstrap(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: a Poisson number of mean one that depends on row and tree alone."""
    x = rows.astype(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F + 1) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(float) / 2.0**53).astype(float)


def _score(left_w, left_s, all_w, all_s):
    """What a split leaves unexplained is lowest where this is highest."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return left_s * left_s / left_w + (all_s - left_s) * (all_s - left_s) / (all_w - left_w)


def _exact_sums(y: np.ndarray, w: np.ndarray) -> bool:
    """Whether sums of weights times labels are free of rounding in any order, as those of whole numbers are."""
    scaled = y * 1024.0
    return bool(np.all(scaled == np.floor(scaled)) and (w * np.abs(scaled)).sum() < 2.0**53)


class _Values:
    """What is added up for rows: weights, weighted labels and, if a leaf must hold more than one, rows; in one number for each row where that is free of rounding.

    Sums of packed numbers hold the sums of the parts side by side, as long as the sums over all rows fit into the 53 bits of a double.
    """

    def __init__(self, y: np.ndarray, w: np.ndarray, with_rows: bool) -> None:
        self.with_rows, self.exact = with_rows, _exact_sums(y, w)
        self.least = self.row_bits = self.label_scale = self.label_place = 0
        if self.exact and len(y):
            self.label_scale = next(2.0**k for k in range(11) if np.all(y * 2.0**k == np.floor(y * 2.0**k)))
            scaled = y * self.label_scale
            self.least = float(scaled.min())
            labels = w * (scaled - self.least)
            bits = [int(v).bit_length() for v in (len(y) if with_rows else 0, w.sum(), labels.sum())]
            if sum(bits) > 53:
                bits[0] = 0  # rows are added up apart
            if sum(bits) <= 53:
                self.row_bits, self.label_place = 2.0 ** bits[0], 2.0 ** (bits[0] + bits[1])
                one = labels * self.label_place + w * self.row_bits + (1.0 if bits[0] else 0.0)
                self.vectors = (one, None) if with_rows and not bits[0] else (one,)
                return
        self.vectors = (w, w * y, None) if with_rows else (w, w * y)

    def parts(self, sums: Sequence[np.ndarray]) -> tuple:
        """Weights, weighted labels and rows (None: not asked for) of sums of the vectors."""
        if not self.label_place:
            return (*sums, None)[:3]
        labels = np.floor(sums[0] / self.label_place)
        rest = sums[0] - labels * self.label_place
        weights, rows = rest, sums[1] if len(sums) > 1 else None
        if self.row_bits > 1:
            weights = np.floor(rest / self.row_bits)
            rows = rest - weights * self.row_bits
        return weights, (labels + self.least * weights) / self.label_scale, rows


class _Layout:
    """The columns of some rows as they are read when splits are looked for: ``data`` has a row for each wide column and for each bundle of narrow ones.

    Bins that no row is in are left out, and so are columns of one bin and those that cut the rows just as an earlier one, which would win.  A bundle is a code of
    several columns: ``table`` tells for each code which cuts have it on their left.  Slots are the cuts of narrow columns and, one each, wide columns, in the order of columns.
    """

    def __init__(self, bins: np.ndarray, bundled: bool) -> None:
        self.bundled, self.columns, self.cuts, self.wide, self.bundles = bundled, [], [], [], []
        data, seen, narrow = [], set(), []
        for c in range(bins.shape[1]):
            column = np.ascontiguousarray(bins[:, c])
            held = np.bincount(column) > 0
            occupied = np.flatnonzero(held)
            if len(occupied) < 2:
                continue
            column = (np.cumsum(held) - 1).astype(bins.dtype)[column]
            if (key := column.tobytes()) in seen:
                continue
            seen.add(key)
            slot = len(self.columns)
            if bundled and len(occupied) <= NARROW:
                narrow.append((column, len(occupied), slot))
                self.columns += [c] * (len(occupied) - 1)
                self.cuts += occupied[:-1].tolist()
            else:
                self.wide.append((len(data), len(occupied), slot, occupied))
                self.columns.append(c)
                self.cuts.append(-1)
                data.append(column)
        while narrow:
            codes, code, cuts, slots = 1, np.zeros(len(bins), bins.dtype), [], []
            while narrow and codes * narrow[0][1] <= CODES:
                column, width, slot = narrow.pop(0)
                code += (column * codes).astype(bins.dtype)
                cuts += [(codes, width, cut) for cut in range(width - 1)]
                slots += range(slot, slot + width - 1)
                codes *= width
            table = np.stack([np.arange(codes) // stride % width <= cut for stride, width, cut in cuts], axis=1).astype(float)
            self.bundles.append((len(data), codes, np.array(slots), table))
            data.append(code)
        self.columns, self.cuts = np.array(self.columns, np.int64), np.array(self.cuts, np.int64)
        self.data = np.stack(data) if data else np.empty((0, len(bins)), bins.dtype)
        #: For each row of the data, how many values it may have; the same number for many, as cells are then numbered alike.
        self.widths = [g[1] for g in sorted([*self.wide, *self.bundles], key=lambda g: g[0])]
        most = max(self.widths, default=1)
        for at, width, _, _ in self.wide:
            self.widths[at] = most if 2 * width > most else width


def _sums(data: np.ndarray, place: np.ndarray, k: int, values: tuple, widths: Sequence[int]) -> list[tuple]:
    """For each row of the data, the sums of the values (None: rows) by node and bin, for nodes 0 to k - 1."""
    out, starts = [], {width: place * width for width in set(widths)}
    for column, width in zip(data, widths, strict=True):
        cells = starts[width] + column
        out.append(tuple(np.bincount(cells, v, k * width).reshape(k, width) for v in values))
    return out


def _sums_of_children(data: np.ndarray, place: np.ndarray, nodes: np.ndarray, rows: np.ndarray, values: tuple, widths: Sequence[int], parents: list[tuple], of: np.ndarray) -> list[tuple]:
    """``_sums`` of some nodes, which are pairs of children of the nodes ``of`` among ``parents``: the smaller one is added up, the other is what is left."""
    pairs = len(nodes) // 2
    small = 2 * np.arange(pairs) + (rows[nodes[1::2]] < rows[nodes[::2]])
    rank = np.full(len(rows), -1)
    rank[nodes[small]] = np.arange(pairs)
    rank = rank[place]
    chosen = np.flatnonzero(rank >= 0)
    own = _sums(data.take(chosen, axis=1), rank[chosen], pairs, tuple(v if v is None else v[chosen] for v in values), widths)
    out = []
    for mine, all_ in zip(own, parents, strict=True):
        both = []
        for part, whole in zip(mine, all_, strict=True):
            sums = np.empty((2 * pairs, part.shape[1]))
            sums[small], sums[small ^ 1] = part, whole[of] - part
            both.append(sums)
        out.append(tuple(both))
    return out


def _scores(left: tuple, rows: np.ndarray, weight: np.ndarray, total: np.ndarray, min_leaf: int) -> np.ndarray:
    """The scores of cuts with weights, labels and rows on their left; -inf where a side would be too small."""
    left_w, left_s, left = left
    can = (left_w > 0) & (left_w < weight)
    if min_leaf > 1:
        can &= (left >= min_leaf) & (rows - left >= min_leaf)
    return np.where(can, _score(left_w, left_s, weight, total), -np.inf)


def _scores_by_sums(layout: _Layout, values: _Values, sums: list[tuple], rows: np.ndarray, weight: np.ndarray, total: np.ndarray, min_leaf: int):
    """For nodes 0, 1, ... with ``_sums``: the best score in each slot, and the best bin of each wide column.  Of equal cuts the lowest wins."""
    k = len(rows)
    scores, cuts = np.full((k, len(layout.columns)), -np.inf), np.zeros((k, len(layout.wide)), np.int64)
    of_nodes = tuple(v[:, None] for v in (rows, weight, total))
    for i, (at, _, slot, _) in enumerate(layout.wide):
        found = _scores(values.parts([np.cumsum(v, axis=1) for v in sums[at]]), *of_nodes, min_leaf)
        cuts[:, i] = np.argmax(found, axis=1)
        scores[:, slot] = found[np.arange(k), cuts[:, i]]
    for at, _, slots, table in layout.bundles:
        scores[:, slots] = _scores(values.parts([np.einsum("kc,cs->ks", v, table) for v in sums[at]]), *of_nodes, min_leaf)
    return scores, cuts


def _scores_by_order(
    layout: _Layout, values: _Values, data: np.ndarray, place: np.ndarray, vectors: tuple, rows: np.ndarray, weight: np.ndarray, total: np.ndarray, min_leaf: int
):
    """The same for nodes of few rows, which lie in the order of their nodes: running sums over rows in the order of bins take less than a sum for each bin."""
    k, n, most = len(rows), len(place), max(layout.widths)
    scores, cuts = np.full((k, len(layout.columns)), -np.inf), np.zeros((k, len(layout.wide)), np.int64)
    vectors = tuple(np.ones(n) if v is None else v for v in vectors)
    first = np.cumsum(rows) - rows
    if layout.wide:
        # All wide columns at once, a row for each.
        keys = (place * most).astype(np.uint16) + data[[at for at, *_ in layout.wide]]
        order = np.argsort(keys, axis=1, kind="stable")
        keys = np.take_along_axis(keys, order, axis=1)
        ends = np.flatnonzero(np.append(keys[:, 1:] != keys[:, :-1], np.zeros((len(keys), 1), bool), axis=1))
        own = place[ends % n]
        left = []
        for v in vectors:
            before = np.append(0.0, np.cumsum(v))[first]
            left.append(np.cumsum(v[order], axis=1).ravel()[ends] - before[own])
        found = _scores(values.parts(left), rows[own], weight[own], total[own], min_leaf)
        able = np.flatnonzero(found > -np.inf)
        if len(able):
            found, own, ends = found[able], own[able], ends[able]
            column = ends // n
            begins = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (column[1:] != column[:-1])))
            best = np.maximum.reduceat(found, begins)
            scores[own[begins], np.array([slot for _, _, slot, _ in layout.wide])[column[begins]]] = best
            chosen = np.flatnonzero(found == np.repeat(best, np.diff(np.append(begins, len(own)))))[::-1]
            cuts[own[chosen], column[chosen]] = keys.ravel()[ends[chosen]] - own[chosen] * most  # the lowest comes last
    for at, _, slots, table in layout.bundles:
        held = table.take(data[at], axis=0)
        left = [np.add.reduceat(held * v[:, None], first, axis=0) for v in vectors]
        scores[:, slots] = _scores(values.parts(left), rows[:, None], weight[:, None], total[:, None], min_leaf)
    return scores, cuts


def grow_in_task(
    bins: np.ndarray, y: np.ndarray, w: np.ndarray, min_leaf: int, min_split: int, depth: int, node: int = 1, level: int = 0, layout: _Layout | None = None
) -> dict[str, np.ndarray]:
    """A subtree below ``node``, all nodes of a level at once, from sums per node and bin.  Rows of weight 0 take no part; other weights are whole numbers.
    ``layout`` may be given for all rows, where several trees are grown from them.

    Of equal splits the first column and lowest bin wins.  Where sums are free of rounding, narrow columns are read together, the larger of two children
    follows from their parent, and nodes of few rows are split by running sums; other labels are added up node by node and bin by bin.
    """
    used = np.flatnonzero(w > 0)
    bins, y, w = bins[used], y[used], w[used]
    values = _Values(y, w, min_leaf > 1)
    exact, vectors = values.exact, values.vectors
    if layout is None or layout.bundled != exact:
        layout, used = _Layout(bins, exact), slice(None)
    data, widths = layout.data[:, used], layout.widths
    most = max(widths, default=1)
    small_rows, small_nodes = (ROWS_TO_SORT if exact and most < 1 << 15 else 0), max(1, (1 << 16) // most - 1)
    wyy = w * y * y
    ids, place = np.array([node]), np.zeros(len(y), np.int64)  # rows lie in the order of their nodes
    at_first = np.arange(len(y))
    out, kept, parent = [], None, np.array([-1])  # sums of the large nodes of the level above, and which of them is whose parent
    while len(place):
        k = len(ids)
        rows = np.bincount(place, minlength=k)
        weight, total, _ = values.parts([np.bincount(place, v, k) for v in vectors])
        squares = np.bincount(place, wyy, k)
        value = total / weight
        made = {"node": ids, "rows": rows, "weight": weight, "value": value, "gain": np.zeros(k), "feature": np.full(k, -1), "bin": np.full(k, -1)}
        out.append(made)
        uneven = squares - total * value > 1e-12 * np.maximum(1.0, squares)
        open_ = uneven & (rows >= max(min_split, 2 * min_leaf)) & (level < depth)
        if not open_.any() or not len(layout.columns):
            break
        column, cut, highest = np.full(k, -1), np.full(k, -1), np.full(k, -np.inf)
        starts, made_sums = np.cumsum(rows) - rows, np.full(k, -1)
        by_parent = exact and kept is not None
        # Pairs of a large parent first, whose sums are known; then the other open nodes, in runs.
        paired = (parent >= 0) & np.repeat(open_.reshape(-1, 2).any(axis=1), 2) if by_parent else np.zeros(k, bool)
        few = open_ & ~paired & (rows < small_rows)
        new_kept, held = [], 0
        at_once = 2 * max(1, CELLS_AT_ONCE // max(1, sum(widths)) // 2)
        for chosen, kind, step in ((np.flatnonzero(paired), "paired", at_once), (np.flatnonzero(open_ & ~paired & ~few), "summed", at_once), (np.flatnonzero(few), "few", small_nodes)):
            for first in range(0, len(chosen), step):
                some = chosen[first : first + step]
                size = rows[some]
                figures = size, weight[some], total[some], min_leaf
                if kind == "paired":
                    sums = _sums_of_children(data, place, some, rows, vectors, widths, kept, parent[some[::2]])
                else:
                    at = np.repeat(starts[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                    own = np.repeat(np.arange(len(some)), size)
                    d, v = (data, vectors) if len(at) == len(place) else (data.take(at, axis=1), tuple(x if x is None else x[at] for x in vectors))
                    sums = None if kind == "few" else _sums(d, own, len(some), v, widths)
                if kind == "few":
                    scores, cuts = _scores_by_order(layout, values, d, own, v, *figures)
                else:
                    scores, cuts = _scores_by_sums(layout, values, sums, *figures)
                    large = np.flatnonzero(open_[some] & (size >= ROWS_TO_SUBTRACT))
                    if exact and len(large):
                        made_sums[some[large]] = held + np.arange(len(large))
                        held += len(large)
                        new_kept.append([tuple(x[large] for x in one) for one in sums])
                slot = np.argmax(scores, axis=1)
                highest[some], column[some], cut[some] = scores[np.arange(len(some)), slot], layout.columns[slot], layout.cuts[slot]
                for i, (_, _, wide_slot, occupied) in enumerate(layout.wide):
                    here = slot == wide_slot
                    cut[some[here]] = occupied[cuts[here, i]]
        kept = [tuple(np.concatenate(x) for x in zip(*column_, strict=True)) for column_ in zip(*new_kept, strict=True)] if new_kept else None
        split = open_ & np.isfinite(highest)
        column[~split] = cut[~split] = -1
        made["feature"], made["bin"] = column, cut
        made["gain"][split] = highest[split] - (total * value)[split]
        # Rows of finished nodes are left out, and the others are numbered anew.
        moved = np.flatnonzero(split[place])
        at_first, place = at_first[moved], place[moved]
        right = bins.ravel()[at_first * bins.shape[1] + column[place]] > cut[place]
        place = 2 * (np.cumsum(split) - 1)[place] + right
        order = np.argsort(place.astype(np.uint16) if 2 * k < 1 << 16 else place, kind="stable")
        moved = moved[order]
        at_first, place = at_first[order], place[order]
        data, wyy, vectors = data.take(moved, axis=1), wyy[moved], tuple(x if x is None else x[moved] for x in vectors)
        parent = np.repeat(made_sums[split], 2)
        ids = np.stack([2 * ids[split], 2 * ids[split] + 1], axis=1).ravel()
        level += 1
    return {c: np.concatenate([m[c] for m in out]) for c in out[0]} if out else {}


def _reached(by_column: np.ndarray, chosen: np.ndarray, splits: Mapping[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """The chosen rows by the node that they reach through the splits made so far, from bins with a row for each column."""
    found = {1: chosen}
    for node in sorted(splits):
        here = found.pop(node)
        column, cut = splits[node]
        right = by_column[column].take(here) > cut
        found[2 * node], found[2 * node + 1] = here[~right], here[right]
    return found


def _larger(batches: Iterator[pd.DataFrame], rows: int = ROWS_AT_ONCE) -> Iterator[pd.DataFrame]:
    """The same rows in batches of about so many."""
    held, size = [], 0
    for whole in batches:
        for first in range(0, len(whole), rows):
            held.append(whole.iloc[first : first + rows])
            size += len(held[-1])
            if size >= rows:
                yield pd.concat(held)
                held, size = [], 0
    if size:
        yield pd.concat(held)


def _unpack(batch: pd.DataFrame, columns: int) -> np.ndarray:
    data = b"".join(batch["bins"])
    return np.frombuffer(data, np.uint8 if len(data) == len(batch) * columns else np.uint16).reshape(len(batch), columns)


def _weights(rows: np.ndarray, fold: np.ndarray, growth: Growth, tree: int, seed: int, drawn: bool) -> np.ndarray:
    w = bootstrap(rows, tree, seed) if drawn else np.ones(len(rows))
    return w if growth.fold is None else np.where(fold == growth.fold, 0.0, w)


@dataclass
class Plan:
    """What is grown: trees of every growth, from rows of ``binned_rows``."""

    growths: tuple[Growth, ...]
    trees: int
    depth: int
    min_split: int
    widths: tuple[int, ...]
    seed: int = 42
    drawn: bool = True
    rows_in_task: int = ROWS_IN_TASK

    @property
    def columns(self) -> int:
        return len(self.widths)

    @property
    def bins(self) -> int:
        return max(self.widths, default=1)


def _top_levels(rows: DataFrame, plan: Plan) -> tuple[dict, list[tuple], set]:
    """Splits of the nodes too large for a task, level by level: {(growth, tree): {node: (column, bin)}}, their node rows, and the nodes below.

    Each level is one job: every task adds up (column, bin) histograms of rows, weight and labels for the large nodes, partial ones are summed
    by node, and the best split of each comes back.  The nodes that are still large number at most rows / rows_in_task per tree.
    """
    splits = {(g, t): {} for g in range(len(plan.growths)) for t in range(plan.trees)}
    made, small, open_nodes, level = [], set(), [(g, t, 1) for g, t in splits], 0
    width = plan.columns * plan.bins
    at_once = max(1, HISTOGRAM_BYTES // (width * 24))
    while open_nodes:
        found = []
        for i in range(0, len(open_nodes), at_once):
            found += _histogram_job(rows, plan, open_nodes[i : i + at_once], splits, level).collect()
        open_nodes = []
        for r in found:
            made.append(tuple(r[c] for c in NODE_COLUMNS))
            if r["feature"] >= 0:
                splits[r["growth"], r["tree"]][r["node"]] = (r["feature"], r["bin"])
                for child, size in ((2 * r["node"], r["left_rows"]), (2 * r["node"] + 1, r["rows"] - r["left_rows"])):
                    key = (r["growth"], r["tree"], child)
                    open_nodes.append(key) if size > plan.rows_in_task else small.add(key)
        level += 1
    return splits, made, small


def _bundles(widths: Sequence[int]) -> list[list[int]]:
    """Columns that are added up together, as a code of their bins: wide ones alone, narrow ones in groups."""
    out, codes = [[c] for c, width in enumerate(widths) if width > NARROW], CODES + 1
    for c, width in enumerate(widths):
        if width <= NARROW:
            if codes * width > CODES:
                out.append([])
                codes = 1
            out[-1].append(c)
            codes *= width
    return out


def _histogram_job(rows: DataFrame, plan: Plan, wanted: list[tuple[int, int, int]], splits: Mapping, level: int) -> DataFrame:
    by_tree: dict[tuple[int, int], list[int]] = {}
    for g, t, node in sorted(wanted):
        by_tree.setdefault((g, t), []).append(node)
    shape = (plan.columns, 3, plan.bins)
    bundles = _bundles(plan.widths)
    codes = [math.prod(plan.widths[c] for c in columns) for columns in bundles]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {key: [np.zeros((3, len(nodes) * k)) for k in codes] for key, nodes in by_tree.items()}
        squares = {key: np.zeros(len(nodes)) for key, nodes in by_tree.items()}
        any_rows = False
        for batch in _larger(batches, ROWS_SUMMED):
            any_rows = True
            y, ids, fold = batch["y"].to_numpy(), batch["row"].to_numpy(), batch["fold"].to_numpy()
            by_column = np.ascontiguousarray(_unpack(batch, plan.columns).T)
            data = [np.ravel_multi_index([by_column[c] for c in columns], [plan.widths[c] for c in columns]) for columns in bundles]
            for (g, t), nodes in by_tree.items():
                w = _weights(ids, fold, plan.growths[g], t, plan.seed, plan.drawn)
                reached = _reached(by_column, np.flatnonzero(w > 0), splits[g, t])
                parts = [reached[n] for n in nodes]
                here, place = np.concatenate(parts), np.repeat(np.arange(len(nodes)), [len(p) for p in parts])
                own, labels = w[here], y[here]
                squares[g, t] += np.bincount(place, own * labels * labels, len(nodes))
                values = _Values(labels, own, True)
                for add, code, k in zip(sums[g, t], data, codes, strict=True):
                    cells = place * k + code.take(here)
                    weights, totals, rows_ = values.parts([np.bincount(cells, v, len(nodes) * k) for v in values.vectors])
                    add += (rows_, weights, totals)
        for (g, t), nodes in by_tree.items() if any_rows else ():
            of_nodes = np.zeros((len(nodes), *shape))
            for columns, found in zip(bundles, sums[g, t], strict=True):
                own = [plan.widths[c] for c in columns]
                found = np.moveaxis(found.reshape(3, len(nodes), *own), 1, 0)
                for i, c in enumerate(columns):
                    of_nodes[:, c, :, : own[i]] = found.sum(axis=tuple(2 + j for j in range(len(own)) if j != i))
            yield pd.DataFrame({"growth": g, "tree": t, "node": nodes, "squares": squares[g, t], "sums": [p.tobytes() for p in of_nodes]})

    def best(group: pd.DataFrame) -> pd.DataFrame:
        n, w, s = np.moveaxis(sum(np.frombuffer(b).reshape(shape) for b in group["sums"]), 1, 0)
        g, t, node = (int(group[c].iloc[0]) for c in ("growth", "tree", "node"))
        rows_, weight, total, squares = n[0].sum(), w[0].sum(), s[0].sum(), group["squares"].sum()
        left_n, left_w, left_s = (np.cumsum(v, axis=1) for v in (n, w, s))
        least = plan.growths[g].min_leaf
        can = (left_n >= least) & (rows_ - left_n >= least) & (left_n > 0) & (left_n < rows_) & (n > 0)
        score = np.where(can, _score(left_w, left_s, weight, total), -np.inf)
        column, cut = np.unravel_index(int(np.argmax(score)), score.shape)
        uneven = squares - total * total / weight > 1e-12 * max(1.0, squares)
        ok = uneven and np.isfinite(score[column, cut]) and level < plan.depth and rows_ >= max(plan.min_split, 2 * least)
        gain = float(score[column, cut] - total * total / weight) if ok else 0.0
        row = (g, t, node, int(rows_), float(weight), float(total / weight), gain, int(column) if ok else -1, int(cut) if ok else -1)
        return pd.DataFrame([(*row, int(left_n[column, cut]))], columns=[*NODE_COLUMNS, "left_rows"])

    packed = rows.mapInPandas(partial, "growth int, tree int, node long, squares double, sums binary")
    return packed.groupBy("growth", "tree", "node").applyInPandas(best, f"{NODES}, left_rows long")


def _in_blocks(rows: DataFrame, plan: Plan, finish, schema: str, own_fold: bool = False) -> tuple[DataFrame, list[tuple]]:
    """``finish(plan, growth, trees, node, rows)`` for all rows of each small node; the root of several trees at once where it is small itself.

    ``own_fold`` sends the rows of the held-out fold along.
    """
    total = rows.count()
    if total <= plan.rows_in_task:
        splits, made, small = {}, [], None
    else:
        splits, made, small = _top_levels(rows, plan)
    in_block = max(1, min(TREES_IN_BLOCK, plan.trees * len(plan.growths) // BLOCKS))
    blocks = [range(i, min(i + in_block, plan.trees)) for i in range(0, plan.trees, in_block)]

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["growth", "tree", "node", "rows", "folds", "ys", "bins"]
        for batch in _larger(batches):
            bins, ids, y = _unpack(batch, plan.columns), batch["row"].to_numpy(), batch["y"].to_numpy()
            fold = batch["fold"].to_numpy().astype(np.int32)
            by_column = np.ascontiguousarray(bins.T)

            def packed(g: int, first: int, node: int, chosen: np.ndarray) -> tuple:
                return g, first, node, ids[chosen].tobytes(), fold[chosen].tobytes() if own_fold else b"", y[chosen].tobytes(), bins[chosen].tobytes()

            for g, growth in enumerate(plan.growths):
                mine = np.ones(len(batch), bool) if own_fold or growth.fold is None else fold != growth.fold
                if small is None:
                    for block in blocks:
                        yield pd.DataFrame([packed(g, block[0], 1, np.flatnonzero(mine))], columns=names)
                    continue
                for t in range(plan.trees):
                    # Rows that a tree does not draw are of use to it only where they are held out.
                    sent_on = mine if own_fold else _weights(ids, fold, growth, t, plan.seed, plan.drawn) > 0
                    pieces = _reached(by_column, np.flatnonzero(sent_on), splits[g, t]).items()
                    yield pd.DataFrame([packed(g, t, node, rows_) for node, rows_ in pieces if len(rows_) and (g, t, node) in small], columns=names)

    def finished(group: pd.DataFrame) -> pd.DataFrame:
        g, first, node = (int(group[c].iloc[0]) for c in ("growth", "tree", "node"))
        ids, fold, y = (np.frombuffer(b"".join(group[c]), k) for c, k in (("rows", np.int64), ("folds", np.int32), ("ys", float)))
        data = b"".join(group["bins"])
        bins = np.frombuffer(data, np.uint8 if len(data) == len(ids) * plan.columns else np.uint16).reshape(len(ids), plan.columns)
        fold = fold if own_fold else np.full(len(ids), -1, np.int32)  # no row of a held-out fold is here
        order = np.argsort(ids, kind="stable")  # sums do not depend on how rows arrived
        trees = range(first, min(first + in_block, plan.trees)) if small is None else range(first, first + 1)
        return finish(plan, g, trees, node, (ids[order], fold[order], y[order], bins[order]))

    groups = len(blocks) * len(plan.growths) if small is None else len(small)
    tasks = max(1, min(groups, TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism))
    moved = rows.mapInPandas(sent, "growth int, tree int, node long, rows binary, folds binary, ys binary, bins binary")
    return moved.repartition(tasks, "growth", "tree", "node").groupBy("growth", "tree", "node").applyInPandas(finished, schema), made


def _nodes_of(plan: Plan, g: int, trees: range, node: int, rows: tuple) -> pd.DataFrame:
    ids, fold, y, bins = rows
    found, layout = [], _Layout(bins, _exact_sums(y, np.ones(len(y))))
    for tree in trees:
        w = _weights(ids, fold, plan.growths[g], tree, plan.seed, plan.drawn)
        grown = grow_in_task(bins, y, w, plan.growths[g].min_leaf, plan.min_split, plan.depth, node, node.bit_length() - 1, layout)
        if grown:
            found.append(pd.DataFrame({"growth": g, "tree": tree} | grown)[list(NODE_COLUMNS)])
    return pd.concat(found) if found else pd.DataFrame(columns=list(NODE_COLUMNS))


def ordered(nodes: Mapping[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The nodes of a tree in the order of their numbers, with the place of the left child; the right one follows it."""
    order = np.argsort(nodes["node"])
    ids = nodes["node"][order]
    return {c: nodes[c][order] for c in ("rows", "value", "feature", "bin")} | {"child": np.searchsorted(ids, 2 * ids)}


def walk(nodes: Mapping[str, np.ndarray], bins: np.ndarray, settings: Sequence[tuple[int, int]]) -> np.ndarray:
    """Predictions of one tree for every (depth, min_split): the tree cut where these settings would have stopped it.

    A tree is grown greedily, so one of less depth or of more rows to split is the top of it.
    """
    if "child" not in nodes:
        nodes = ordered(nodes)
    rows, value, feature, cut, child = (nodes[c] for c in ("rows", "value", "feature", "bin", "child"))
    at = np.zeros(len(bins), np.int64)
    going = np.ones((len(settings), len(bins)), bool)
    out = np.zeros((len(settings), len(bins)))
    level, left = 0, np.arange(len(bins))
    while len(left):
        here = at[left]
        for i, (depth, least) in enumerate(settings):
            stop = going[i, left] & ((feature[here] < 0) | (level >= depth) | (rows[here] < least))
            out[i, left[stop]] = value[here[stop]]
            going[i, left[stop]] = False
        left = left[(feature[here] >= 0) & going[:, left].any(axis=0)]
        here = at[left]
        at[left] = child[here] + (bins[left, feature[here]] > cut[here])
        level += 1
    return out


def steps(nodes: Mapping[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The values of a tree's nodes, and in one number each what a row needs to go on: the place of the left child, the bin that is cut after, and the column.

    A leaf leads to itself, as no bin is above the highest.
    """
    nodes = ordered(nodes)
    leaf = nodes["feature"] < 0
    child = np.where(leaf, np.arange(len(leaf)), nodes["child"]).astype(np.int64)
    cut, feature = (np.where(leaf, end, nodes[c]).astype(np.int64) for c, end in (("bin", 0xFFFF), ("feature", 0)))
    return {"value": nodes["value"], "step": child << 32 | cut << 16 | feature}


def leaf_values(nodes: Mapping[str, np.ndarray], bins: np.ndarray) -> np.ndarray:
    """Predictions of one whole tree, given as ``steps``."""
    step, flat = nodes["step"], bins.ravel()
    out = np.zeros(len(bins), np.int64)
    at, left, first = out.copy(), None, np.arange(len(bins)) * bins.shape[1]
    while len(at):
        for _ in range(STEPS_AT_ONCE):
            here = step.take(at)
            at = (here >> 32) + (flat.take(first + (here & 0xFFFF)) > (here >> 16 & 0xFFFF))
        going = np.flatnonzero(step.take(at) >> 16 & 0xFFFF != 0xFFFF)
        if left is None:
            out, left = at.copy(), np.arange(len(bins))
        else:
            out[left] = at
        at, left, first = at[going], left[going], first[going]
    return nodes["value"].take(out)


def tree_groups(nodes: DataFrame, nodes_at_once: int = NODES_AT_ONCE) -> Iterator[list[dict[str, np.ndarray]]]:
    """The trees of a table of nodes as ``steps``, in groups of at most ``nodes_at_once`` nodes, or one tree."""
    sizes = {r["tree"]: r["n"] for r in nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}
    groups, size = [[]], 0
    for tree, n in sorted(sizes.items()):
        if groups[-1] and size + n > nodes_at_once:
            groups.append([])
            size = 0
        groups[-1].append(tree)
        size += n
    for group in groups:
        frame = nodes.where(F.col("tree").isin(group)).select("tree", "node", "rows", "value", "feature", "bin").toPandas()
        yield [steps({c: part[c].to_numpy() for c in part}) for _, part in frame.groupby("tree")]


@dataclass
class Forest:
    """A grown forest as a table of nodes (``NODES``), with the edges that cut its columns into bins."""

    nodes: DataFrame
    edges: dict[str, list[float]]
    trees: int

    def predict(self, matrix: DataFrame, key: str = "item_id", output: str = "prediction", nodes_at_once: int = NODES_AT_ONCE) -> DataFrame:
        """key and the mean prediction of all trees.  Trees are broadcast in groups of at most ``nodes_at_once`` nodes, or one tree."""
        spark = matrix.sparkSession
        columns, arrays = list(self.edges), [np.asarray(e, float) for e in self.edges.values()]
        out = matrix.select(key, *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).withColumn("_sum", F.lit(0.0))
        for trees in tree_groups(self.nodes, nodes_at_once):
            shared = spark.sparkContext.broadcast(trees)

            def add(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    if len(batch):
                        bins = np.stack([np.searchsorted(e, batch[f"x{i}"].to_numpy(float)) for i, e in enumerate(arrays)], axis=1).astype(np.uint16)
                        yield batch.assign(_sum=batch["_sum"] + sum(leaf_values(tree, bins) for tree in shared.value))

            out = out.mapInPandas(add, out.schema)
        return out.select(key, (F.col("_sum") / self.trees).alias(output))

    def importances(self) -> DataFrame:
        """feature and its share of what all splits explain, each tree counting alike."""
        gains = self.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        own = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
        shares = gains.join(own, "tree").groupBy("feature").agg(F.sum(F.try_divide("gain", "whole")).alias("share"))
        whole = shares.agg(F.sum("share")).first()[0] or 1.0
        names = self.nodes.sparkSession.createDataFrame(list(enumerate(self.edges)), "feature int, name string")
        found = names.join(F.broadcast(shares), "feature", "left")
        return found.select(F.col("name").alias("feature"), (F.coalesce("share", F.lit(0.0)) / F.lit(whole)).alias("importance"))

    def save(self, path: str) -> str:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = self.nodes.sparkSession.createDataFrame([(json.dumps(self.edges), self.trees)], "edges string, trees int")
        meta.coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forest:
        row = spark.read.parquet(f"{path}/metadata").first()
        return cls(spark.read.parquet(f"{path}/nodes"), json.loads(row["edges"]), row["trees"])


def fit_forest(
    matrix: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    key: str = "item_id",
    trees: int = FOREST_DEFAULTS["trees"],
    depth: int = FOREST_DEFAULTS["depth"],
    min_split: int = FOREST_DEFAULTS["min_split"],
    min_leaf: int = FOREST_DEFAULTS["min_leaf"],
    max_bins: int = MAX_BINS,
    seed: int = 42,
    drawn: bool = True,
    rows_in_task: int = ROWS_IN_TASK,
) -> Forest:
    """A forest over all labelled rows; ``drawn=False`` gives every tree each row once.

    Nodes of fewer than ``min_split`` rows are not split, and no split leaves fewer than ``min_leaf`` on a side.  Rows without a label are left out; an
    empty table has no nodes and predicts 0.
    """
    known = matrix.where(F.col(label).isNotNull()).select(key, label, *[F.col(f"`{c}`") for c in columns])
    known = cut_lineage(known, "forest-table")
    edges = bin_edges(known, columns, max_bins)
    rows = cut_lineage(binned_rows(known, edges, label, key), "forest-rows")
    plan = Plan((Growth(min_leaf),), trees, depth, min_split, tuple(len(e) + 1 for e in edges.values()), seed, drawn, rows_in_task)
    grown, made = _in_blocks(rows, plan, _nodes_of, NODES)
    if made:
        grown = grown.unionByName(matrix.sparkSession.createDataFrame(made, NODES))
    return Forest(cut_lineage(grown, "forest-nodes"), edges, trees)


def exact_tree(
    matrix: DataFrame,
    columns: Sequence[str],
    label: str = "label",
    depth: int = FOREST_DEFAULTS["depth"],
    min_split: int = FOREST_DEFAULTS["min_split"],
    min_leaf: int = FOREST_DEFAULTS["min_leaf"],
    rows_in_slice: int = ROWS_IN_SLICE,
) -> DataFrame:
    """One tree over all labelled rows, each once, with every value of a column a possible cut: node, rows, value, feature, threshold.

    The tree that ``fit_forest`` grows without drawing where its bins hold one value each, for columns of any number of values.  A level
    sums rows and labels by node, column and value; running sums are made inside slices of about ``rows_in_slice`` rows, to which the
    sums of the slices before are added, so no task gets a whole column.  Of equal splits the first column and lowest value wins;
    thresholds lie halfway to the next value of the whole column; a missing value goes with the largest.
    """
    known = matrix.where(F.col(label).isNotNull()).select(
        F.lit(1).cast("long").alias("node"), F.col(label).cast("double").alias("y"),
        *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns)],
    )
    at = cut_lineage(_sliced(cut_lineage(known, "tree-table"), len(columns), rows_in_slice), "tree-rows")
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"x{i}").alias("x"), F.col(f"slice{i}").alias("slice")) for i in range(len(columns))]))
    own_slice, slices_before = Window.partitionBy("node", "feature", "slice").orderBy("x"), Window.partitionBy("node", "feature").orderBy("slice")
    all_slices = Window.partitionBy("node", "feature")
    column_values, grown = None, []
    for level in range(depth + 1):
        made = at.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("total"), F.sum(F.col("y") * F.col("y")).alias("squares"))
        made = cut_lineage(made.withColumn("value", F.col("total") / F.col("rows")), "tree-nodes")
        uneven = F.col("squares") - F.col("total") * F.col("value") > 1e-12 * F.greatest(F.lit(1.0), "squares")
        open_nodes = made.where(uneven & (F.col("rows") >= max(min_split, 2 * min_leaf))).select("node", "rows", "total")
        if level == depth or open_nodes.isEmpty():
            grown.append(made.select("node", "rows", "value", F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold")))
            break
        sums = at.select("node", "y", cells.alias("cell")).select("node", "y", "cell.*").where("x IS NOT NULL")
        sums = cut_lineage(sums.groupBy("node", "feature", "slice", "x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")), "tree-sums")
        column_values = sums.select("feature", "x") if column_values is None else column_values
        slices = sums.groupBy("node", "feature", "slice").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        earlier = slices_before.rowsBetween(Window.unboundedPreceding, -1)
        slices = slices.select(
            "node", "feature", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"), F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("s0"),
            F.sum("n").over(all_slices).alias("with_value"),
        )
        running = sums.select("node", "feature", "slice", "x", F.sum("n").over(own_slice).alias("n"), F.sum("s").over(own_slice).alias("s"))
        left_n, left_s, right_n, right_s = F.col("n") + F.col("n0"), F.col("s") + F.col("s0"), F.col("rows") - F.col("left_n"), F.col("total") - F.col("left_s")
        steps = running.join(slices, ["node", "feature", "slice"]).withColumns({"left_n": left_n, "left_s": left_s}).join(open_nodes, "node")
        steps = steps.where((F.col("left_n") < F.col("with_value")) & (F.col("left_n") >= min_leaf) & (right_n >= min_leaf))
        gain = F.col("left_s") * F.col("left_s") / F.col("left_n") + right_s * right_s / right_n
        best = steps.groupBy("node").agg(F.max(F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("x")).alias("x"))).alias("best"))
        best = cut_lineage(best.select("node", (-F.col("best.f")).alias("feature"), (-F.col("best.x")).alias("cut")), "tree-cuts")
        following = best.join(column_values, "feature").where("x > cut").groupBy("node").agg(F.min("x").alias("following"))
        cuts = best.join(following, "node").select("node", "feature", ((F.col("cut") + F.col("following")) / 2).alias("threshold"))
        grown.append(made.join(cuts, "node", "left").select("node", "rows", "value", "feature", "threshold"))
        own = F.array(*[F.col(f"x{i}") for i in range(len(columns))])[F.col("feature")]
        moved = at.join(best, "node").withColumn("node", 2 * F.col("node") + F.coalesce(own > F.col("cut"), F.lit(True)).cast("long"))
        at = cut_lineage(moved.drop("feature", "cut"), "tree-rows")
    names = matrix.sparkSession.createDataFrame(list(enumerate(columns)), "feature int, name string")
    found = reduce(DataFrame.unionByName, grown).join(F.broadcast(names), "feature", "left")
    return found.select("node", "rows", "value", F.col("name").alias("feature"), "threshold")


def _sliced(known: DataFrame, columns: int, rows_in_slice: int) -> DataFrame:
    """``known`` with ``slice0``, ``slice1``, ...: numbers of ranges of the columns, which ascend with the values and hold about so many rows."""
    slices = -(-known.count() // rows_in_slice)
    shares = [i / slices for i in range(1, slices)]
    if not shares:
        return known.withColumns({f"slice{i}": F.lit(0.0) for i in range(columns)})
    found = known.agg(*[F.percentile_approx(f"x{i}", shares, 10_000).alias(f"x{i}") for i in range(columns)]).first()
    for i in range(columns):
        edges = [-math.inf, *sorted(set(found[f"x{i}"] or [0.0]) - {-math.inf, math.inf}), math.inf]
        known = Bucketizer(splits=edges if len(edges) > 2 else [-math.inf, 0.0, math.inf], inputCol=f"x{i}", outputCol=f"slice{i}", handleInvalid="keep").transform(known)
    return known


def grid_report(
    matrix: DataFrame,
    columns: Sequence[str],
    fold: str,
    folds: int = 5,
    grid: Mapping[str, Sequence[int]] | None = None,
    label: str = "label",
    key: str = "item_id",
    max_bins: int = MAX_BINS,
    seed: int = 42,
    rows_in_task: int = ROWS_IN_TASK,
) -> DataFrame:
    """R² and RMSE on the held-out rows of each fold, for every setting of the grid: trees, depth, min_split, min_leaf, fold, rows, r2, rmse.

    Only the minimum in a leaf changes how trees grow: for each of its values and each fold the most trees are grown once, as deep and with as few rows to
    split as any setting wants.  The rows held out are routed along, and each setting reads its prediction from the top of the same trees and
    from the first trees.  So 81 settings cost three growths a fold, and binning and rows are shared by all.
    """
    grid = {**FULL_GRID, **(grid or {})}
    known = matrix.where(F.col(label).isNotNull() & F.col(fold).isNotNull()).select(key, label, fold, *[F.col(f"`{c}`") for c in columns])
    known = cut_lineage(known, "forest-table")
    edges = bin_edges(known, columns, max_bins)
    rows = cut_lineage(binned_rows(known, edges, label, key, fold), "forest-rows")
    growths = tuple(Growth(leaf, f) for leaf in grid["min_leaf"] for f in range(folds))
    cuts = list(product(grid["depth"], grid["min_split"]))
    widths = tuple(len(e) + 1 for e in edges.values())
    plan = Plan(growths, max(grid["trees"]), max(grid["depth"]), min(grid["min_split"]), widths, seed, True, rows_in_task)
    if rows.count() > rows_in_task:
        return _grid_of_large(matrix, plan, rows, grid, cuts, fold)

    def tested(plan: Plan, g: int, trees: range, node: int, data: tuple) -> pd.DataFrame:
        ids, held, y, bins = data
        test = np.flatnonzero(held == plan.growths[g].fold)
        out = []
        if len(test):
            sums, layout = np.zeros((len(grid["trees"]), len(cuts), len(test))), _Layout(bins, _exact_sums(y, np.ones(len(y))))
            for tree in trees:
                w = _weights(ids, held, plan.growths[g], tree, plan.seed, plan.drawn)
                grown = grow_in_task(bins, y, w, plan.growths[g].min_leaf, plan.min_split, plan.depth, layout=layout)
                if grown:
                    sums[np.array(grid["trees"]) > tree] += walk(grown, bins[test], cuts)
            out = [(g, int(i), float(v), s.ravel().tolist()) for i, v, s in zip(ids[test], y[test], np.moveaxis(sums, 2, 0), strict=True)]
        return pd.DataFrame(out, columns=["growth", "row", "y", "sums"])

    parts, _ = _in_blocks(rows, plan, tested, "growth int, row long, y double, sums array<double>", own_fold=True)
    return _scored(parts, plan, grid, cuts)


def _scored(parts: DataFrame, plan: Plan, grid: Mapping, cuts: list) -> DataFrame:
    """Sums of predictions of blocks of trees to figures of settings."""
    spark, wide = parts.sparkSession, len(grid["trees"]) * len(cuts)
    added = parts.groupBy("growth", "row", "y").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(wide)])
    listed = [(i, t, d, m) for i, (t, (d, m)) in enumerate(product(grid["trees"], cuts))]
    errors = {i: F.col("y") - F.col(f"s{i}") / t for i, t, _, _ in listed}
    figures = added.groupBy("growth").agg(
        F.count(F.lit(1)).alias("rows"), (F.var_pop("y") * F.count(F.lit(1))).alias("spread"),
        F.array(*[F.sum(errors[i] * errors[i]) for i in range(wide)]).alias("squares"),
    ).select("growth", "rows", "spread", F.posexplode("squares").alias("setting", "square"))
    settings = spark.createDataFrame(listed, "setting int, trees int, depth int, min_split int")
    growths = spark.createDataFrame([(i, g.min_leaf, g.fold) for i, g in enumerate(plan.growths)], "growth int, min_leaf int, fold int")
    both = figures.join(F.broadcast(settings), "setting").join(F.broadcast(growths), "growth")
    return both.select(
        "trees", "depth", "min_split", "min_leaf", "fold", "rows", (1 - F.try_divide("square", "spread")).alias("r2"), F.sqrt(F.col("square") / F.col("rows")).alias("rmse")
    )


def _grid_of_large(matrix: DataFrame, plan: Plan, rows: DataFrame, grid: Mapping, cuts: list, fold: str) -> DataFrame:
    """The same where roots are too large for a task: the trees are stored first, then read in groups over the rows held out."""
    grown, made = _in_blocks(rows, plan, _nodes_of, NODES)
    grown = cut_lineage(grown.unionByName(matrix.sparkSession.createDataFrame(made, NODES)), "forest-nodes")
    parts = []
    for g, growth in enumerate(plan.growths):
        held = rows.where(F.col("fold") == growth.fold)
        for first in range(0, plan.trees, TREES_IN_BLOCK):
            last = min(first + TREES_IN_BLOCK, plan.trees)
            frame = grown.where((F.col("growth") == g) & F.col("tree").between(first, last - 1)).toPandas()
            shared = matrix.sparkSession.sparkContext.broadcast([(int(t), ordered({c: p[c].to_numpy() for c in p})) for t, p in frame.groupby("tree")])

            def tested(batches: Iterator[pd.DataFrame], shared=shared, g=g) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    if len(batch):
                        bins = _unpack(batch, plan.columns)
                        sums = np.zeros((len(grid["trees"]), len(cuts), len(batch)))
                        for tree, nodes in shared.value:
                            sums[np.array(grid["trees"]) > tree] += walk(nodes, bins, cuts)
                        yield pd.DataFrame({"growth": g, "row": batch["row"], "y": batch["y"], "sums": list(np.moveaxis(sums, 2, 0).reshape(len(batch), -1))})

            parts.append(cut_lineage(held.mapInPandas(tested, "growth int, row long, y double, sums array<double>"), "forest-sums"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return _scored(out, plan, grid, cuts)


def best_setting(report: DataFrame) -> dict[str, float]:
    """The setting with the highest mean R² over the folds; ties go to fewer trees, less depth, more rows to split, larger leaves."""
    means = report.groupBy("trees", "depth", "min_split", "min_leaf").agg(F.avg("r2").alias("r2"))
    row = means.orderBy(F.desc("r2"), "trees", "depth", F.desc("min_split"), F.desc("min_leaf")).first()
    return row.asDict() if row is not None else {}


def search_forest(
    matrix: DataFrame,
    columns: Sequence[str],
    folds: int = 5,
    test_fraction: float = 0.2,
    grid: Mapping[str, Sequence[int]] | None = None,
    label: str = "label",
    key: str = "item_id",
    **options,
) -> tuple[Forest, dict[str, float]]:
    """The forest of the best setting, fitted on the training part, with that setting, its mean R² over the folds and the metrics of the part held out."""
    known = matrix.where(F.col(label).isNotNull()).select(key, F.col(label).alias("label"), *columns)
    parts = cut_lineage(split_sets(known, {"train": 1 - test_fraction, "test": test_fraction}, key=key).withColumn("_fold", fold_of(key, folds)), "forest-parts")
    training = parts.where(F.col("set") == "train")
    best = best_setting(grid_report(training, columns, "_fold", folds, grid, key=key, **options))
    if not best:
        raise ValueError("there are no rows to search on")
    score = best.pop("r2")
    forest = fit_forest(training, columns, key=key, **best, **options)
    held = parts.where(F.col("set") == "test")
    report = metrics_by_set(held.join(forest.predict(held, key), key)).first()
    return forest, {**best, "cv_score": score, **({m: report[m] for m in METRICS} if report is not None else {})}
