import itertools
import math

import pytest

from partledger.operators import baskets


@pytest.fixture(scope="module")
def pairs(spark):
    groups = ["abc"] * 4 + ["ab"] * 3 + ["cd"] * 2 + ["ad"] + ["e"] * 5
    rows = [(str(i), item) for i, group in enumerate(groups) for item in group] + [("0", "a")]
    df = spark.createDataFrame(rows, "CLAIMNO string, part string")
    return baskets.multi_item(baskets.basket_items(df, "part"))


def brute(min_support):
    groups = [set(g) for g in ["abc"] * 4 + ["ab"] * 3 + ["cd"] * 2 + ["ad"]]
    found = {}
    for k in range(1, 5):
        for items in itertools.combinations("abcd", k):
            freq = sum(set(items) <= g for g in groups)
            if freq and freq / len(groups) >= min_support:
                found[items] = freq
    return found, len(groups)


@pytest.mark.parametrize("support", [0.01, 0.3, 0.4])
def test_itemsets(pairs, support):
    found = baskets.frequent_itemsets(pairs, support)
    wanted, n = brute(support)
    assert found.baskets == n
    assert {tuple(r["items"]): r["freq"] for r in found.table.collect()} == wanted


def test_rules(pairs):
    sets, n = brute(0.01)
    rules = baskets.association_rules(baskets.frequent_itemsets(pairs, 0.01).table, min_confidence=0.1, min_lift=None)
    got = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in rules.collect()}
    wanted = set()
    for items, freq in sets.items():
        for k in range(1, len(items)):
            for left in itertools.combinations(items, k):
                right = tuple(i for i in items if i not in left)
                if freq / sets[left] < 0.1:
                    continue
                wanted.add((left, right))
                row = got[left, right]
                a, c, s = sets[left] / n, sets[right] / n, freq / n
                assert math.isclose(row["lift"], s / a / c) and math.isclose(row["leverage"], s - a * c, abs_tol=1e-12)
                conf = s / a
                assert row["conviction"] == math.inf if conf == 1 else math.isclose(row["conviction"], (1 - c) / (1 - conf))
                worst = max(s * (1 - a), a * (c - s))
                assert math.isclose(row["zhangs_metric"], (s - a * c) / worst if worst else 0, abs_tol=1e-12)
    assert set(got) == wanted
    assert any(len(right) == 2 for _, right in wanted)


def test_summary_of_nothing(spark, pairs):
    none = baskets.frequent_itemsets(pairs.where("claim = 'x'"))
    assert none.baskets == 0 and none.table.count() == 0
    row = baskets.rules_summary(none.table, baskets.association_rules(none.table)).first()
    assert row["num_rules"] == 0 and row["avg_lift"] is None
    assert baskets.frequent_itemsets(pairs, 0.99).table.count() == 0


def test_rare_items_do_not_reach_the_prefix_trees(spark, monkeypatch):
    """Many items that are frequent alone but never together: only the items of frequent pairs are mined as trees."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(5)
    claims = {c: set(rng.choice(60, 3, replace=False)) | ({100, 101, 102} if c % 9 == 0 else set()) for c in range(900)}
    rows = [(f"c{c}", f"i{i:03d}") for c, items in claims.items() for i in items]
    pairs = spark.createDataFrame([*rows, ("c1", None), (None, "i001")], "claim string, item string").coalesce(2)
    mined = []
    real = baskets.FPGrowth.fit
    monkeypatch.setattr(baskets.FPGrowth, "fit", lambda self, df: mined.append(df.count()) or real(self, df))
    found = baskets.frequent_itemsets(baskets.multi_item(pairs), 0.02)
    counts = {}
    for items in claims.values():
        for k in range(1, 5):
            for some in itertools.combinations(sorted(items), k):
                counts[some] = counts.get(some, 0) + 1
    wanted = {tuple(f"i{i:03d}" for i in s): n for s, n in counts.items() if n / 900 >= 0.02}
    assert found.baskets == 900 and len(wanted) > 60
    assert {tuple(r["items"]): r["freq"] for r in found.table.collect()} == wanted
    assert mined == [100]


def test_claims_of_several_items_take_one_shuffle(spark):
    pairs = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), (None, "x"), (None, "y")], "claim string, item string")
    kept = baskets.multi_item(pairs)
    assert {tuple(r) for r in kept.collect()} == {("a", "x"), ("a", None)}
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "SortMergeJoin" not in plan and "HashJoin" not in plan and plan.count("Exchange") == 1
