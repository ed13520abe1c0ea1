import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from partledger.operators import evaluate, sampling


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)
    rows = [(i, int(a), float(b), int(b >= 0.5)) for i, (a, b) in enumerate(zip(y, s))]
    return spark.createDataFrame(rows, "id int, y int, s double, p int"), y, s


def test_areas(scored):
    df, y, s = scored
    pos, neg = s[y == 1], s[y == 0]
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert np.isclose(evaluate.roc_auc(df, "y", "s").first()[0], wins)
    ap, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        recall, precision = (pos >= t).mean(), y[s >= t].mean()
        ap, last = ap + (recall - last) * precision, recall
    assert np.isclose(evaluate.average_precision(df, "y", "s").first()[0], ap)
    for row in evaluate.roc_curve(df, "y", "s").collect():
        assert np.isclose(row.tpr, (pos >= row.threshold).mean()) and np.isclose(row.fpr, (neg >= row.threshold).mean())


def test_one_class_has_no_area(scored):
    df, _, _ = scored
    assert evaluate.roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_zero_divisions(scored):
    df, _, _ = scored
    row = evaluate.binary_metrics(df.withColumn("p", F.lit(0)), "y", "p").first()
    assert row["precision"] == row["recall"] == row["f1_score"] == 0.0


def test_thresholds(spark, scored):
    df, y, s = scored
    sweep = evaluate.threshold_sweep(df, "y", "s")
    rows = sweep.collect()
    assert len(rows) == 17
    for r in rows:
        p = s >= r.threshold
        tp = (p & (y == 1)).sum()
        assert np.isclose(r.f1_score, 2 * tp / (p.sum() + (y == 1).sum()))
    best = max(r.f1_score for r in rows)
    assert evaluate.best_threshold(sweep) == round(min(r.threshold for r in rows if r.f1_score == best), 2)
    assert evaluate.best_threshold(evaluate.threshold_sweep(df.withColumn("s", F.lit(0.0)), "y", "s")) == 0.5


@pytest.mark.parametrize("block", [2048, 3])
def test_clusters(spark, block):
    pts = [(0, 0.0, 0.0, 0), (1, 0.0, 1.0, 0), (2, 1.0, 0.0, 0), (3, 8.0, 8.0, 1), (4, 9.0, 8.0, 1), (5, 4.0, 4.0, 2)]
    df = spark.createDataFrame(pts, "id int, x double, y double, label int").withColumn("v", F.array("x", "y"))
    xy, lab = np.array([p[1:3] for p in pts]), np.array([p[3] for p in pts])
    d = np.linalg.norm(xy[:, None] - xy[None, :], axis=2)
    values = []
    for i in range(len(pts)):
        own = (lab == lab[i]) & (np.arange(len(pts)) != i)
        if not own.any():
            values.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, lab == k].mean() for k in set(lab) - {lab[i]})
        values.append((b - a) / max(a, b))
    assert np.isclose(evaluate.silhouette(df, "id", "v", "label", block).first()["silhouette"], np.mean(values))
    mean = xy.mean(axis=0)
    between = sum((lab == k).sum() * ((xy[lab == k].mean(axis=0) - mean) ** 2).sum() for k in set(lab))
    within = sum(((xy[lab == k] - xy[lab == k].mean(axis=0)) ** 2).sum() for k in set(lab))
    found = evaluate.calinski_harabasz(df, [F.col("x"), F.col("y")], "label").first()["calinski_harabasz"]
    assert np.isclose(found, (between / 2) / (within / 3))
    single = df.withColumn("label", F.lit(1))
    assert evaluate.silhouette(single, "id", "v", "label").first()["silhouette"] is None
    assert evaluate.calinski_harabasz(single, [F.col("x")], "label").first()["calinski_harabasz"] is None


def test_split_and_folds(spark):
    df = spark.range(1003).withColumn("IS_FRAUD", (F.col("id") % 7 == 0).cast("int"))
    split = sampling.stratified_split(df, "id").toPandas()
    assert len(split) == 1003
    for _, part in split.groupby("IS_FRAUD"):
        assert (part["split"] == "test").sum() == round(0.2 * len(part))
    assert (sampling.stratified_split(df.drop("IS_FRAUD"), "id").toPandas()["split"] == "test").sum() == 201
    folds = sampling.repeated_folds(df, "id", splits=5, repeats=2).toPandas()
    assert len(folds) == 2006
    sizes = folds.groupby(["repeat", "IS_FRAUD", "fold"]).size().groupby(level=[0, 1])
    assert ((sizes.max() - sizes.min()) <= 1).all()


def test_scaler_and_weights(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (3.0, 5.0, 0), (8.0, 5.0, 1)], "a double, b double, IS_FRAUD int")
    scaled = sampling.apply_scaler(df, sampling.fit_scaler(df, ["a", "b"])).toPandas()
    assert np.allclose(scaled["a"], (np.array([1, 3, 8]) - 4) / np.std([1, 3, 8])) and (scaled["b"] == 0).all()
    weights = {r["IS_FRAUD"]: r["weight"] for r in sampling.class_weights(df).collect()}
    assert weights == {0: 0.75, 1: 1.5}


def test_silhouette_block_count_is_bounded(spark, monkeypatch):
    """Rows travel a fixed number of times; copies of an id are no distance to themselves."""
    seen = []
    real = evaluate.block_join
    monkeypatch.setattr(evaluate, "block_join", lambda *a: seen.append(a[-1]) or real(*a))
    monkeypatch.setattr(evaluate, "BLOCK_ROWS", 2)
    df = spark.range(640).select("id", F.array(F.rand(1), F.rand(2)).alias("v"), (F.col("id") % 2).alias("label"))
    assert evaluate.silhouette(df, "id", "v", "label").first()["labels"] == 2 and seen == [40]
    row, own = evaluate._own_places(pd.Series(["a", None, "b"]), pd.Series(["b", "a", None, "a"]))
    assert sorted(zip(row.tolist(), own.tolist())) == [(0, 1), (0, 3), (1, 2), (2, 0)]
    assert not len(evaluate._own_places(pd.Series([np.nan]), pd.Series([np.nan]))[0])
