"""Forests grown together: cuts, prefixes, tables that no task may hold, and plain recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from partledger.operators import forest, grow, grow_wide, sampling
from tests.test_models import blob


def table(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 9)).round(2)
    fraud = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=n)) > 1.2).astype(np.int64)
    codes = np.stack([np.searchsorted(np.quantile(x[:, k], np.arange(1, 32) / 32), x[:, k], "left") for k in range(9)], 1).astype(np.uint8)
    return grow.Table(np.sort(rng.integers(-(2**62), 2**62, n)), fraud, codes, rng.integers(0, 3, (n, 2)).astype(np.int16))


def job(t, repeat=None, fold=None):
    learn = np.ones(len(t.row), bool) if repeat is None else t.places[:, repeat] != fold
    return grow.Job(0, repeat, fold, *grow._balance({y: int((t.fraud[learn] == y).sum()) for y in (0, 1)}))


def plain_tree(t, one, tree, rules):
    """The same tree by recursion over rows."""
    learn, _ = t.split(one)
    drawn = grow.bootstrap(t.row[learn], np.array([tree]), rules.seed)[0]
    weight = {0: one.clean, 1: one.fraud}
    nodes = {}

    def visit(rows, node, depth):
        a, b = (sum(drawn[i] for i in rows if t.fraud[learn[i]] == y) * weight[y] for y in (0, 1))
        nodes[node] = b / (a + b)
        if not (a and b) or len(rows) < max(2, rules.min_split) or depth >= rules.deepest:
            return
        order = grow.feature_order(grow._tree_seeds(np.array([tree]), rules.seed), np.array([node]), 9)[0]
        best = None
        for start in (0, 3, 6):
            for f in order[start : start + 3]:
                for c in sorted({t.codes[learn[i], f] for i in rows})[:-1]:
                    sides = [[i for i in rows if (t.codes[learn[i], f] > c) == right] for right in (False, True)]
                    total = 0.0
                    for side in sides:
                        w = [sum(drawn[i] for i in side if t.fraud[learn[i]] == y) * weight[y] for y in (0, 1)]
                        total += (w[0] ** 2 + w[1] ** 2) / (w[0] + w[1])
                    if best is None or total > best[0] + 1e-9:
                        best = (total, sides)
            if best:
                break
        if best:
            visit(best[1][0], 2 * node, depth + 1)
            visit(best[1][1], 2 * node + 1, depth + 1)

    visit([i for i in range(len(learn)) if drawn[i]], 1, 0)
    return nodes


def test_equals_plain_recursion():
    t = table(150)
    for rules in (grow.Rules(3, 4, 2, 42), grow.Rules(3, None, 12, 7)):
        one = job(t, 1, 2)
        nodes, _, _ = t.grow(one, np.arange(3), rules)
        for tree in range(3):
            mine = nodes["tree"] == tree
            got = dict(zip(nodes["node"][mine].tolist(), nodes["p"][mine].tolist()))
            assert got == pytest.approx(plain_tree(t, one, tree, rules))


def test_cuts_are_the_smaller_trees():
    t, depths, splits = table(), [2, 5, None], [2, 7, 40]
    one = job(t, 0, 1)
    _, _, all_cuts = t.grow(one, np.arange(12), grow.Rules(12, None, 2, 42), (depths, splits))
    for i, depth in enumerate(depths):
        for j, least in enumerate(splits):
            _, _, alone = t.grow(one, np.arange(4, 9), grow.Rules(12, depth, least, 42), ([depth], [least]))
            assert np.array_equal(all_cuts[4:9, :, i * 3 + j], alone[:, :, 0])


def stored(spark, t):
    rows = [(int(r), int(y), [int(p) for p in place], c.tobytes()) for r, y, place, c in zip(t.row, t.fraud, t.places, t.codes)]
    return spark.createDataFrame(rows, "row long, fraud int, places array<int>, codes binary").repartition(3)


def test_wide_tables_grow_the_same_trees(spark, monkeypatch):
    t, rules = table(), grow.Rules(4, 6, 3, 42)
    rows = stored(spark, t)
    jobs = grow.jobs_of(rows, 2, 3)[1:3]
    order = ["job", "tree", "node"]
    near = grow.fit_nodes(rows, jobs, rules).orderBy(*order).collect()
    near_shares = {(r["job"], r["band"], r["row"]): list(r["shares"]) for r in grow.held_out_shares(rows, jobs, rules, [1, 4], [2, 6], [3, 9]).collect()}
    monkeypatch.setattr(grow, "LOCAL_ROWS", 90)
    assert grow.fit_nodes(rows, jobs, rules).orderBy(*order).collect() == near
    wide = {(r["job"], r["band"], r["row"]): list(r["shares"]) for r in grow.held_out_shares(rows, jobs, rules, [1, 4], [2, 6], [3, 9]).collect()}
    assert wide.keys() == near_shares.keys()
    assert all(wide[k] == pytest.approx(v) for k, v in near_shares.items())


def test_cuts_by_histogram_and_by_sorting():
    rng = np.random.default_rng(3)
    slot, code, drawn = rng.integers(0, 3, 4000), rng.integers(0, 40, 4000), rng.integers(1, 9, 4000)
    bad = rng.integers(0, 2, 4000)
    counts = (drawn * (1 - bad), drawn * bad)
    cells = {}
    for s, c, a, b in zip(slot, code, *counts):
        old = cells.get(s * 256 + c, (0, 0))
        cells[s * 256 + c] = (old[0] + a, old[1] + b)
    for part, slots in ((slice(None), 3), (slice(0, 90), 3)):  # many rows a cell, few
        key, clean, fraud = grow._by_cell(slot[part], code[part], counts[0][part], counts[1][part], slots)
        assert (np.diff(key) >= 0).all() and (clean.sum(), fraud.sum()) == (counts[0][part].sum(), counts[1][part].sum())
        if part == slice(None):
            assert {int(k): (a, b) for k, a, b in zip(key, clean, fraud)} == cells


def test_cells_of_packed_draws():
    """Class and draws in one byte give the cells that separate counts give, by sums and by sorting."""
    rng = np.random.default_rng(4)
    slot, code, drawn, bad = rng.integers(0, 3, 4000), rng.integers(0, 128, 4000), rng.integers(1, 10, 4000), rng.integers(0, 2, 4000)
    draws = np.where(bad == 1, drawn, drawn << 4).astype(np.uint8)
    for rows, sums in ((slice(None), True), (slice(0, 90), False)):
        want = grow._by_cell(slot[rows], code[rows], (drawn * (1 - bad))[rows], (drawn * bad)[rows], 3)
        found = grow._few_or_sums(slot[rows] * 256 + code[rows], draws[rows], grow._DRAWS.take(draws[rows]) if sums else None)
        assert all(np.array_equal(a, b) for a, b in zip(found, want))


def test_long_tables_grow_few_trees_at_a_time(spark, monkeypatch):
    t, rules = table(), grow.Rules(5, 6, 3, 42)
    assert [len(x) for x in t.bites(np.arange(5))] == [5]
    rows = stored(spark, t)
    jobs = grow.jobs_of(rows, 2, 3)[1:3]
    found = lambda: {(r["job"], r["band"], r["row"]): list(r["shares"]) for r in grow.held_out_shares(rows, jobs, rules, [5], [2, 6], [3]).collect()}
    whole = found()
    monkeypatch.setattr(grow, "DRAWS_AT_ONCE", 1300)
    assert [len(x) for x in t.bites(np.arange(5))] == [2, 2, 1]
    few = t.grow(jobs[0], np.arange(5), rules)[0]
    parts = [t.grow(jobs[0], x, rules)[0] for x in t.bites(np.arange(5))]
    order = np.lexsort((few["node"], few["tree"]))
    assert sum(len(x["node"]) for x in parts) == len(order)
    split = found()
    assert whole.keys() == split.keys() and all(split[k] == pytest.approx(v) for k, v in whole.items())


def test_grid_point_equals_its_own_cross_validation(spark):
    folds = sampling.repeated_folds(blob(spark, 150, 40).withColumn("total_amount", F.col("total_amount") + 6 * F.rand(3)), "CLAIMNO", splits=3, repeats=2)
    folds = folds.cache()
    ranking = forest.grid_search(folds, {"trees": [3, 8], "depth": [2, None], "min_split": [2, 6]})
    assert len(ranking) == 8 and [f for _, f in ranking] == sorted((f for _, f in ranking), reverse=True)
    for params, f1 in ranking[::3]:
        lines = forest.cross_validate(folds, params=params)
        assert len(lines) == 6 and np.mean([r["f1_score"] for r in lines]) == pytest.approx(f1)


def test_rows_of_a_node_travel_together(spark):
    t, rules = table(), grow.Rules(4, 6, 3, 42)
    rows, one = stored(spark, t).coalesce(1), job(t, 0, 1)
    upper = {(0, k): grow_wide.Upper(splits={1: (0, 9)}, rest={2, 3}) for k in range(4)}
    found = grow_wide._routed(rows, [one], upper, rules, True).collect()
    assert len(found) == 8  # two nodes of each tree, not a row for each draw
    learn, held = t.split(one)
    for r in found:
        drawn = grow.bootstrap(t.row[learn], np.array([r["tree"]]), rules.seed)[0]
        right = t.codes[:, 0] > 9
        here = right if r["node"] == 3 else ~right
        assert len(r["learn"]) == 10 * (drawn[here[learn]] > 0).sum() and len(r["held"]) == 18 * here[held].sum()


def test_scores_are_the_mean_of_the_leaves(spark, monkeypatch):
    df = blob(spark, 150, 40)
    model = forest.fit(df, params=forest.ForestParams(trees=9, depth=None, min_split=2))
    whole = {r["CLAIMNO"]: r["fraud_probability"] for r in forest.score(df, model).collect()}
    monkeypatch.setattr(forest, "SCORE_NODES", 10)
    assert {r["CLAIMNO"]: r["fraud_probability"] for r in forest.score(df, model).collect()} == pytest.approx(whole)
    shape = model.nodes.groupBy("tree").agg(F.count("*").alias("n"), F.count_if(F.col("feature") < 0).alias("leaves")).collect()
    assert len(shape) == 9 and all(r["n"] == 2 * r["leaves"] - 1 for r in shape)


def test_one_class_and_null_labels(spark):
    df = blob(spark, 60, 0)
    assert {r["fraud_probability"] for r in forest.score(df, forest.fit(df, params=forest.ForestParams(trees=3))).collect()} == {0.0}
    mixed = blob(spark, 60, 20).withColumn("IS_FRAUD", F.when(F.col("CLAIMNO") != "c0003", F.col("IS_FRAUD")))
    assert forest.score(mixed, forest.fit(mixed, params=forest.ForestParams(trees=3))).count() == 80
