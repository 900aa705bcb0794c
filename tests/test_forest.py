"""The histogram forest against a plain CART on few rows, and grids against separate fits."""

import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from shelfrank.operators import forest as forest_module
from shelfrank.operators.forest import (
    FULL_GRID,
    Forest,
    best_setting,
    bin_edges,
    bootstrap,
    exact_tree,
    fit_forest,
    grid_report,
    grow_in_task,
    leaf_values,
    steps,
    walk,
)
from shelfrank.operators.quality import make_regressor

COLUMNS = ["a", "b", "c"]


def rows_of(seed, n=180):
    r = random.Random(seed)
    return [(i, float(r.randint(0, 40)), float(r.randint(0, 3)), r.random(), float(r.randint(0, 20))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, a double, b double, c double, label double")


def plain_tree(x, y, w, depth, min_split, min_leaf, level=0):
    """A CART by trying every column and every value."""
    x, y, w = x[w > 0], y[w > 0], w[w > 0]
    value = float((w * y).sum() / w.sum())
    if level >= depth or len(y) < max(min_split, 2 * min_leaf) or len(set(y)) == 1:
        return value
    best = None
    for column in range(x.shape[1]):
        for cut in sorted(set(x[:, column]))[:-1]:
            left = x[:, column] <= cut
            if min(left.sum(), (~left).sum()) < min_leaf:
                continue
            lw, ls, aw, total = w[left].sum(), (w * y)[left].sum(), w.sum(), (w * y).sum()
            score = ls * ls / lw + (total - ls) * (total - ls) / (aw - lw)
            if best is None or score > best[0]:
                best = (score, column, cut, left)
    if best is None:
        return value
    _, column, cut, left = best
    sides = [plain_tree(x[s], y[s], w[s], depth, min_split, min_leaf, level + 1) for s in (left, ~left)]
    return (column, cut, value, len(y), *sides)


def plain_predict(tree, row):
    while isinstance(tree, tuple):
        tree = tree[4] if row[tree[0]] <= tree[1] else tree[5]
    return tree


@pytest.mark.parametrize("seed, min_split, min_leaf, depth", [(1, 2, 1, 30), (2, 10, 1, 15), (3, 5, 4, 6), (4, 2, 2, 3)])
def test_a_tree_equals_a_plain_cart(seed, min_split, min_leaf, depth):
    data = np.array(rows_of(seed))
    bins = np.stack([np.unique(data[:, i], return_inverse=True)[1] for i in (1, 2, 3)], axis=1)
    y, w = data[:, 4], bootstrap(data[:, 0].astype(np.int64), seed, 42)
    grown = grow_in_task(bins, y, w, min_leaf, min_split, depth)
    plain = plain_tree(bins, y, w, depth, min_split, min_leaf)
    want = [plain_predict(plain, row) for row in bins]
    assert np.allclose(walk(grown, bins, [(99, 0)])[0], want, rtol=0, atol=1e-9)


def test_shallower_trees_are_tops_of_deeper_ones():
    data = np.array(rows_of(5))
    bins = np.stack([np.unique(data[:, i], return_inverse=True)[1] for i in (1, 2, 3)], axis=1)
    y, w = data[:, 4], np.ones(len(data))
    settings = [(2, 2), (4, 10), (8, 5), (30, 2)]
    found = walk(grow_in_task(bins, y, w, 2, 2, 30), bins, settings)
    for i, (depth, min_split) in enumerate(settings):
        assert np.array_equal(found[i], walk(grow_in_task(bins, y, w, 2, min_split, depth), bins, [(99, 0)])[0])


def test_larger_children_follow_from_their_parents(monkeypatch):
    r = np.random.default_rng(5)
    bins = np.concatenate([r.integers(0, 20, (4000, 3)), r.integers(0, 2, (4000, 3))], axis=1).astype(np.uint8)
    y, w = bins[:, 0] // 4 + 3.0 * bins[:, 4] + r.integers(0, 6, 4000), bootstrap(np.arange(4000), 1, 42)
    plain, seen = np.bincount, []
    monkeypatch.setattr(np, "bincount", lambda x, *args, **named: (seen.append(len(x)), plain(x, *args, **named))[1])

    def grown(labels):
        seen.clear()
        return grow_in_task(bins, labels, w, 2, 10, 6), sum(seen)

    whole, _ = grown(y)
    monkeypatch.setattr(forest_module, "ROWS_TO_SUBTRACT", 1, raising=False)
    every, few = grown(y)
    # A third of a label is no whole number, so nodes are added up one by one.
    thirds, many = grown(y / 3)
    assert few < 0.75 * many
    for c in ("node", "rows", "weight", "feature", "bin"):
        assert np.array_equal(whole[c], thirds[c]) and np.array_equal(whole[c], every[c])
    assert np.array_equal(whole["value"], every["value"]) and np.allclose(whole["value"], 3 * thirds["value"])


def test_nodes_of_few_rows_cost_rows_and_not_bins(monkeypatch):
    r = np.random.default_rng(6)
    bins = np.concatenate([r.integers(0, 120, (3000, 4)), r.integers(0, 3, (3000, 5))], axis=1).astype(np.uint8)
    bins = np.concatenate([bins, bins[:, :2], 2 * bins[:, 2:3] + 1, r.integers(0, 2, (3000, 8)).astype(np.uint8)], axis=1)
    y, w = r.integers(-9, 30, 3000) / 4, bootstrap(np.arange(3000), 2, 42)
    plain, cells = np.bincount, []
    monkeypatch.setattr(np, "bincount", lambda x, weights=None, minlength=0: (cells.append(int(minlength)), plain(x, weights, int(minlength)))[1])
    for min_leaf in (1, 3):
        cells.clear()
        found = grow_in_task(bins, y, w, min_leaf, 2, 30)
        few = sum(cells)
        cells.clear()
        # Thirds are no whole numbers, so every node is summed up bin by bin.
        grow_in_task(bins, y / 3, w, min_leaf, 2, 30)
        assert few < 0.2 * sum(cells)
        with monkeypatch.context() as patched:
            patched.setattr(forest_module, "ROWS_TO_SORT", 0)
            summed = grow_in_task(bins, y, w, min_leaf, 2, 30)
        # A layout of all rows of a task serves trees that draw some of them.
        again = grow_in_task(bins, y, w, min_leaf, 2, 30, layout=forest_module._Layout(bins, True))
        assert all(np.array_equal(found[c], summed[c]) and np.array_equal(found[c], again[c]) for c in found)


def test_values_packed_or_not_have_the_same_sums():
    r = np.random.default_rng(7)
    w = r.integers(1, 5, 500).astype(float)
    for y in (r.integers(-5, 50, 500) / 8, r.integers(0, 1 << 40, 500).astype(float), r.random(500)):
        for with_rows in (False, True):
            values = forest_module._Values(y, w, with_rows)
            weights, labels, rows = values.parts([len(y) if v is None else v.sum() for v in values.vectors])
            assert weights == w.sum() and (labels == (w * y).sum() or not values.exact and abs(labels / (w * y).sum() - 1) < 1e-12)
            assert rows == (len(y) if with_rows else None)


def test_rows_reach_the_leaves_that_a_walk_finds():
    data = np.array(rows_of(11, 700))
    bins = np.stack([np.unique(data[:, i], return_inverse=True)[1] for i in (1, 2, 3)], axis=1).astype(np.uint16)
    for depth in (0, 1, 4, 5, 30):
        grown = grow_in_task(bins, data[:, 4], np.ones(len(data)), 1, 2, depth)
        assert np.array_equal(leaf_values(steps(grown), bins), walk(grown, bins, [(99, 0)])[0])
    assert len(leaf_values(steps(grown), bins[:0])) == 0


@pytest.mark.parametrize("max_bins", [4, 30, 128])
def test_edges_lie_between_few_values_or_at_quantiles(spark, max_bins):
    rows = [(i, a, b, None if i % 7 == 0 else c, y) for i, a, b, c, y in rows_of(12, 600)]
    edges = bin_edges(frame(spark, rows).repartition(3), [*COLUMNS, "label"], max_bins)
    for i, c in enumerate([*COLUMNS, "label"], 1):
        values = sorted({r[i] for r in rows} - {None})
        between = [(p + q) / 2 for p, q in zip(values, values[1:])]
        assert edges[c] == between if len(values) < 0.8 * max_bins else len(edges[c]) < max_bins and set(edges[c]) <= set(values)
    assert bin_edges(frame(spark, []), COLUMNS, max_bins) == {c: [] for c in COLUMNS}


def test_bootstrap_weights_have_mean_and_spread_of_one():
    w = bootstrap(np.arange(200_000), 3, 42)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    assert np.corrcoef(w, bootstrap(np.arange(200_000), 4, 42))[0, 1] < 0.01


def nodes_of(forest):
    return sorted((r["tree"], r["node"], r["rows"], round(r["value"], 9), r["feature"], r["bin"]) for r in forest.nodes.collect())


def test_levels_over_all_tasks_give_the_same_forest_as_one_task(spark):
    matrix = frame(spark, rows_of(6, 400)).repartition(5)
    settings = dict(trees=3, depth=6, min_split=4, min_leaf=2)
    whole = fit_forest(matrix, COLUMNS, **settings)
    levels = fit_forest(matrix, COLUMNS, rows_in_task=60, **settings)
    alone = fit_forest(matrix, COLUMNS, rows_in_task=0, **settings)
    assert nodes_of(whole) == nodes_of(levels) == nodes_of(alone)


def test_minimum_rows_hold_in_every_node(spark):
    found = fit_forest(frame(spark, rows_of(7)), COLUMNS, trees=2, min_split=25, min_leaf=7).nodes
    assert found.where("feature >= 0").agg(F.min("rows")).first()[0] >= 25
    assert found.agg(F.min("rows")).first()[0] >= 7


def test_predictions_importances_and_storage(spark, tmp_path):
    rows = [(i, a, b, c, 3 * a + (1 if b > 1 else 0)) for i, a, b, c, _ in rows_of(8, 300)] + [(999, 1.0, None, 2.0, None)]
    matrix = frame(spark, rows)
    grown = fit_forest(matrix, COLUMNS, trees=20, min_split=2)
    stored = Forest.load(spark, grown.save(str(tmp_path / "forest")))
    got = {r[0]: r[1] for r in grown.predict(matrix).collect()}
    again = {r[0]: r[1] for r in stored.predict(matrix, nodes_at_once=1).collect()}
    assert got.keys() == again.keys() and all(abs(got[k] - again[k]) < 1e-9 for k in got)
    assert np.mean([abs(got[r[0]] - r[4]) for r in rows[:-1]]) < 1.5
    importance = {r["feature"]: r["importance"] for r in grown.importances().collect()}
    assert abs(sum(importance.values()) - 1) < 1e-9 and importance["a"] > 0.9


def test_an_empty_table_has_no_nodes(spark):
    grown = fit_forest(frame(spark, []), COLUMNS, trees=2)
    assert grown.nodes.count() == 0
    assert fit_forest(frame(spark, [(1, 1.0, 1.0, 1.0, None)]), COLUMNS, trees=2).nodes.count() == 0


@pytest.mark.parametrize("rows_in_task", [100_000, 80])
def test_a_grid_equals_separate_fits(spark, rows_in_task, monkeypatch):
    monkeypatch.setattr(forest_module, "TREES_IN_BLOCK", 2)
    matrix = frame(spark, rows_of(9, 150)).withColumn("f", (F.col("item_id") % 2).cast("int"))
    grid = {"trees": (2, 3), "depth": (2, 8), "min_split": (2, 12), "min_leaf": (1, 3)}
    report = {tuple(r)[:5]: r for r in grid_report(matrix, COLUMNS, "f", 2, grid, max_bins=256, rows_in_task=rows_in_task).collect()}
    assert len(report) == 32
    data = np.array([tuple(r) for r in matrix.select("item_id", "a", "b", "c", "label", "f").collect()], dtype=float)
    bins = np.stack([np.unique(data[:, i], return_inverse=True)[1] for i in (1, 2, 3)], axis=1)
    ids = np.array([r[0] for r in matrix.select(forest_module.hash60("item_id", F.lit("forest"))).collect()])
    for (trees, depth, min_split, min_leaf, fold), row in report.items():
        test = data[:, 5] == fold
        guess = np.zeros(test.sum())
        for tree in range(trees):
            w = np.where(test, 0, bootstrap(ids, tree, 42))
            plain = plain_tree(bins, data[:, 4], w, depth, min_split, min_leaf)
            guess += [plain_predict(plain, x) for x in bins[test]]
        error = data[test, 4] - guess / trees
        assert row["rows"] == test.sum()
        assert abs(row["rmse"] - np.sqrt((error**2).mean())) < 1e-9
        assert abs(row["r2"] - (1 - (error**2).mean() / data[test, 4].var())) < 1e-9
    assert best_setting(grid_report(matrix, COLUMNS, "f", 2, grid, max_bins=256))["r2"] == pytest.approx(
        max(np.mean([report[(*s, f)]["r2"] for f in (0, 1)]) for s in {k[:4] for k in report})
    )


def test_the_full_grid_has_81_settings():
    assert np.prod([len(v) for v in FULL_GRID.values()]) == 81


def test_the_model_type_is_this_forest_and_can_be_stored(spark, tmp_path):
    matrix = frame(spark, rows_of(10, 200))
    data = VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(matrix)
    model = PipelineModel([make_regressor("random_forest", numTrees=3, minRowsToSplit=6).fit(data)])
    model.write().save(str(tmp_path / "model"))
    want = {r[0]: r[1] for r in fit_forest(matrix, COLUMNS, trees=3, min_split=6).predict(matrix).collect()}
    for stage in (model, PipelineModel.load(str(tmp_path / "model"))):
        got = {r[0]: r[1] for r in stage.transform(data).select("item_id", "prediction").collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert abs(sum(stage.stages[0].featureImportances) - 1) < 1e-9
    assert make_regressor("random_forest", numTrees=2).fit(data.drop("item_id")).transform(data).count() == 200


@pytest.mark.parametrize("rows_in_slice", [15, 1000])
def test_exact_tree_is_the_tree_of_bins_that_hold_one_value(spark, rows_in_slice):
    rows = [(i, None if i % 17 == 0 else a, b, c, None if i % 29 == 0 else y) for i, a, b, c, y in rows_of(9)]
    data = frame(spark, rows)
    binned = fit_forest(data, COLUMNS, trees=1, depth=4, min_split=6, min_leaf=2, max_bins=1000, drawn=False)
    expected = {
        r["node"]: (r["rows"], r["value"], *((None, None) if r["feature"] < 0 else (COLUMNS[r["feature"]], binned.edges[COLUMNS[r["feature"]]][r["bin"]])))
        for r in binned.nodes.collect()
    }
    found = exact_tree(data, COLUMNS, depth=4, min_split=6, min_leaf=2, rows_in_slice=rows_in_slice).collect()
    assert {r["node"]: tuple(r)[1:] for r in found} == expected


def test_exact_tree_of_nothing_and_of_equal_labels(spark):
    assert exact_tree(frame(spark, []), COLUMNS).collect() == []
    same = [(i, a, b, c, 3.0) for i, a, b, c, _ in rows_of(2, 20)]
    assert [tuple(r) for r in exact_tree(frame(spark, same), COLUMNS).collect()] == [(1, 20, 3.0, None, None)]
