"""Quality measures of labels, scores and clusterings, all exact."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from partledger.functions.numbers import ratio_or_zero
from partledger.operators.blocks import BLOCK_ROWS, block_join, matrix
from partledger.operators.ordering import running_totals
from partledger.session import checkpointed

BLOCKS = 16  # of either side of all distances
BLOCK_BYTES = 64 << 20  # of the numbers in a block
STRIP_CELLS = 1 << 18  # distances that are in memory at once
THRESHOLDS = [float(t) for t in np.arange(0.10, 0.91, 0.05)]


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """One row: ``tn, fp, fn, tp``."""
    y, p = F.col(truth), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio_or_zero(2 * tp, 2 * tp + fp + fn)


def binary_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Accuracy, and precision / recall / F1 of class 1; undefined ratios are 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusion(df, truth, pred).select(
        ratio_or_zero(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1_score"),
    )


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """``label, precision, recall, f1_score, support`` per class plus accuracy, macro and weighted rows."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    classes = {
        "Normal": (ratio_or_zero(tn, tn + fn), ratio_or_zero(tn, tn + fp), _f1(tn, fn, fp), tn + fp),
        "Fraud": (ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn), _f1(tp, fp, fn), tp + fn),
    }
    everything = tn + fp + fn + tp
    right = ratio_or_zero(tn + tp, everything)
    n, f = classes["Normal"], classes["Fraud"]
    rows = dict(classes)
    rows["accuracy"] = (right, right, right, everything)
    rows["macro avg"] = (*[(n[i] + f[i]) / 2 for i in range(3)], everything)
    rows["weighted avg"] = (*[ratio_or_zero(n[i] * n[3] + f[i] * f[3], everything) for i in range(3)], everything)
    names = ("precision", "recall", "f1_score", "support")
    lines = [
        F.struct(F.lit(label).alias("label"), *[v.alias(name) for v, name in zip(values, names)])
        for label, values in rows.items()
    ]
    return confusion(df, truth, pred).select(F.explode(F.array(*lines)).alias("r")).select("r.*")


def _score_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Distinct scores from high to low with running counts of positives and negatives."""
    counts = checkpointed(
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))
    )
    curve = running_totals(counts, "threshold", ["pos", "neg"], descending=True)
    return curve.withColumns(
        {"all_pos": counts.select(F.sum("pos")).scalar(), "all_neg": counts.select(F.sum("neg")).scalar()}
    )


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """``threshold, fpr, tpr`` per distinct score."""
    return _score_curve(df, truth, score).select(
        "threshold",
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
    )


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when one class is missing."""
    area = F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0))
    whole = F.max(F.col("all_pos").cast("double") * F.col("all_neg"))
    return _score_curve(df, truth, score).agg(F.try_divide(area, whole).alias("roc_auc"))


def pr_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """``threshold, precision, recall, baseline`` per distinct score."""
    return _score_curve(df, truth, score).select(
        "threshold",
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide("cum_pos", "all_pos").alias("recall"),
        (F.col("all_pos") / (F.col("all_pos") + F.col("all_neg"))).alias("baseline"),
    )


def average_precision(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Precision at every distinct score, weighted by the recall gained there."""
    gain = F.try_divide(F.col("pos").cast("double"), "all_pos")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return _score_curve(df, truth, score).agg(F.sum(gain * precision).alias("average_precision"))


def threshold_sweep(df: DataFrame, truth: str, score: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """``threshold, tp, fp, fn, f1_score`` for each threshold, in one pass over the rows."""
    y, s = F.col(truth), F.col(score)
    counts = []
    for i, t in enumerate(thresholds):
        hit = s >= F.lit(t)
        counts += [
            F.count_if(hit & (y == 1)).alias(f"tp{i}"),
            F.count_if(hit & (y == 0)).alias(f"fp{i}"),
            F.count_if(~hit & (y == 1)).alias(f"fn{i}"),
        ]
    lines = [
        F.struct(F.lit(t).alias("threshold"), *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "fn")])
        for i, t in enumerate(thresholds)
    ]
    table = df.agg(*counts).select(F.explode(F.array(*lines)).alias("r")).select("r.*")
    return table.withColumn("f1_score", _f1(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(sweep: DataFrame, fallback: float = 0.5) -> float:
    """Lowest threshold with the highest F1; ``fallback`` when every F1 is 0."""
    top = sweep.where("f1_score > 0").orderBy(F.desc("f1_score"), "threshold").first()
    return round(top["threshold"], 2) if top else fallback


def _own_places(a: pd.Series, b: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values in ``a`` and ``b``, in order of the first."""
    codes, _ = pd.factorize(pd.concat([a, b], ignore_index=True))
    left, right = codes[: len(a)], codes[len(a) :]
    order = np.argsort(right, kind="stable")
    low, high = (np.searchsorted(right[order], left, side) for side in ("left", "right"))
    if a.dtype != object:  # a missing number equals nothing
        high = np.where(left < 0, low, high)
    count = high - low
    row = np.repeat(np.arange(len(left)), count)
    return row, order[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]


def silhouette(df: DataFrame, key: str, vector: str, label: str, block_rows: int | None = None) -> DataFrame:
    """Mean Euclidean silhouette over all rows, and the number of labels; null with fewer than two.

    All distances are needed by definition. They are summed block by block, one row per (point, label). Each side is cut into
    ``BLOCKS`` blocks, so every row travels that often whatever the table holds; into more only where a block would exceed ``BLOCK_BYTES``.
    """
    points = checkpointed(
        df.select(F.col(key).alias("id"), F.col(vector).alias("x"), F.col(label).alias("label"), F.lit(0).alias("cell"))
    )
    kind = dict(points.dtypes)
    schema = f"id {kind['id']}, own {kind['label']}, other {kind['label']}, total double"
    if block_rows is None:
        shape = points.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("x")).alias("width")).first()
        most = BLOCK_BYTES // (8 * max(1, shape["width"] or 1))
        block_rows = max(1, min(most, max(BLOCK_ROWS, math.ceil(shape["rows"] / BLOCKS))))

    def sums(left: pa.Table, right: pa.Table) -> pd.DataFrame:
        x, y = matrix(left["x"]), matrix(right["x"])
        a, b = left.drop_columns("x").to_pandas(), right.drop_columns("x").to_pandas()
        labels = b["label"].to_numpy()
        others = pd.unique(labels)
        places = [np.flatnonzero(labels == other) for other in others]
        order, ends = np.concatenate(places), np.cumsum([0, *map(len, places)])
        y = y[order]
        row, own = _own_places(a["id"], b["id"].iloc[order]) if a["l_block"].iloc[0] == a["r_block"].iloc[0] else (np.zeros(0, int), np.zeros(0, int))
        near, far, total = (x * x).sum(1)[:, None], (y * y).sum(1)[None, :], np.zeros((len(x), len(others)))
        step = max(1, STRIP_CELLS // max(1, len(y)))
        for first in range(0, len(x), step):
            strip = x[first : first + step] @ y.T
            strip *= -2.0
            strip += near[first : first + step]
            strip += far
            np.sqrt(np.maximum(strip, 0.0, out=strip), out=strip)
            low, high = np.searchsorted(row, [first, first + step])
            strip[row[low:high] - first, own[low:high]] = 0.0
            for k in range(len(others)):
                total[first : first + step, k] = strip[:, ends[k] : ends[k + 1]].sum(axis=1)
        return pd.concat([pd.DataFrame({"id": a["id"], "own": a["label"], "other": other, "total": total[:, k]}) for k, other in enumerate(others)])

    partial = block_join(points, points, "id", "id", sums, schema, block_rows)
    sizes = points.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    totals = partial.groupBy("id", "own", "other").agg(F.sum("total").alias("total"))
    mean = F.try_divide("total", F.when(F.col("own") == F.col("other"), F.col("n") - 1).otherwise(F.col("n")))
    per_point = (
        totals.join(F.broadcast(sizes.withColumnRenamed("label", "other")), "other")
        .withColumn("mean", mean)
        .groupBy("id")
        .agg(
            F.max(F.when(F.col("own") == F.col("other"), F.col("mean"))).alias("a"),
            F.min(F.when(F.col("own") != F.col("other"), F.col("mean"))).alias("b"),
        )
    )
    value = F.when(F.col("a").isNull(), 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    labels = sizes.select(F.count(F.lit(1))).scalar()
    return per_point.agg(F.avg(value).alias("silhouette")).select(
        F.when(labels > 1, F.col("silhouette")).alias("silhouette"), labels.alias("labels")
    )


def calinski_harabasz(df: DataFrame, columns: Sequence[Column], label: str) -> DataFrame:
    """Between-cluster over within-cluster variance; one aggregation per cluster, one over all rows."""
    wide = df.select(F.col(label).alias("label"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    spread = sum((F.var_pop(f"x{i}") for i in range(len(columns))), F.lit(0.0)) * F.count(F.lit(1))
    clusters = wide.groupBy("label").agg(spread.alias("within"))
    whole = wide.agg(spread.alias("whole"), F.count(F.lit(1)).alias("n"))
    parts = clusters.agg(F.sum("within").alias("within"), F.count(F.lit(1)).alias("k"))
    k, n = F.col("k"), F.col("n")
    joined = parts.withColumns({"whole": whole.select("whole").scalar(), "n": whole.select("n").scalar()})
    value = F.try_divide((F.col("whole") - F.col("within")) * (n - k), F.col("within") * (k - 1))
    return joined.select(F.when(k > 1, value).alias("calinski_harabasz"), k.alias("labels"))


def model_comparison(metrics: DataFrame, models: Sequence[str]) -> DataFrame:
    """``metric`` rows against one column per model; input is ``section, metric, value``."""
    return metrics.where(F.col("section").isin(list(models))).groupBy("metric").pivot("section", list(models)).agg(
        F.first("value")
    )
