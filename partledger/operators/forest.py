"""Supervised fraud scoring: random forests with balanced classes and a tuned threshold."""

from __future__ import annotations

import itertools
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from partledger.config import DEFAULTS, FEATURES, TRUTH
from partledger.functions.numbers import ratio_or_zero
from partledger.operators import grow
from partledger.operators.blocks import spread
from partledger.operators.evaluate import best_threshold, classification_report, threshold_sweep
from partledger.operators.ordering import null_safe_join, running_totals
from partledger.operators.sampling import Scaler, fit_scaler
from partledger.session import checkpointed, ship_package
from partledger.sources.files import path_exists

SCORE_NODES = 4_000_000  # nodes of the trees that are sent to the tasks at once
CV_METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")


@dataclass(frozen=True)
class ForestParams:
    trees: int = DEFAULTS.rf_trees
    depth: int | None = DEFAULTS.rf_depth
    min_split: int = DEFAULTS.rf_min_split
    seed: int = DEFAULTS.seed


@dataclass
class ForestModel:
    """``nodes`` is a stored table; ``limits`` are the bins of each feature. Trees don't need the scaler, its users may."""

    features: tuple[str, ...]
    scaler: Scaler
    limits: list[list[float]]
    nodes: DataFrame
    params: ForestParams
    threshold: float = 0.5
    parts: dict[str, DataFrame] = field(default_factory=dict)  # stored next to it, see ``evaluation``


def _rules(params: ForestParams) -> grow.Rules:
    return grow.Rules(params.trees, params.depth, params.min_split, params.seed)


def _row(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def _key(df: DataFrame, features: Sequence[str]) -> Column:
    """A row's number: the hash of its claim id, or of its features where there is none."""
    return (_row(DEFAULTS.claim_id) if DEFAULTS.claim_id in df.columns else F.xxhash64(*features)).alias("row")


def _train(df: DataFrame, label: str, features: Sequence[str], params: ForestParams) -> ForestModel:
    limits = grow.bin_limits(df, features)
    known = df.where(F.col(label).isNotNull())
    rows = known.select(_key(df, features), F.col(label).cast("int").alias("fraud"), F.array().cast("array<int>").alias("places"), *features)
    rows = checkpointed(grow.binned(spread(rows), features, limits, ("row", "fraud", "places")))
    nodes = grow.fit_nodes(rows, grow.jobs_of(rows, 0, 0), _rules(params))
    return ForestModel(tuple(features), fit_scaler(df, features), limits, nodes, params)


class _Trees:
    """Some trees as arrays: children and splits by position."""

    def __init__(self, nodes: pa.Table):
        tree, node, feature, code, p = (nodes[c].to_numpy() for c in ("tree", "node", "feature", "code", "p"))
        order = np.lexsort((node, tree))
        tree, node, feature, code, self.p = (x[order] for x in (tree, node, feature, code, p))
        self.roots = np.flatnonzero(np.append(True, tree[1:] != tree[:-1]))
        left = np.arange(len(node))  # a leaf leads back to itself
        ends = np.append(self.roots[1:], len(node))
        for a, b in zip(self.roots.tolist(), ends.tolist()):  # node numbers are sorted inside a tree
            inner = a + np.flatnonzero(feature[a:b] >= 0)
            left[inner] = a + np.searchsorted(node[a:b], 2 * node[inner])
        self.leaf = feature < 0
        self.step = left << 16 | np.where(self.leaf, 0, feature) << 8 | np.where(self.leaf, 255, code)

    def shares(self, codes: np.ndarray) -> np.ndarray:
        """Sum over the trees of the fraud share of each row's leaf."""
        total, flat = np.zeros(len(codes)), codes.ravel()
        first = np.arange(len(codes)) * codes.shape[1]
        for root in self.roots.tolist():
            at, begin, live = np.full(len(codes), root), first, np.arange(len(codes))
            while len(live):
                for _ in range(4):  # rows at a leaf stay there until they are taken out
                    step = self.step.take(at)
                    at = step >> 16
                    code = step & 255
                    step >>= 8
                    step &= 255
                    step += begin
                    at += flat.take(step) > code
                done = self.leaf.take(at)
                total[live[done]] += self.p.take(at[done])
                on = np.flatnonzero(~done)
                at, begin, live = at.take(on), begin.take(on), live.take(on)
        return total


def score(df: DataFrame, model: ForestModel) -> DataFrame:
    """Add ``fraud_probability`` and ``is_fraud``; a label column is called ``truth`` from here on.

    The probability is the mean over the trees of the leaf's fraud share. Trees go to the tasks in groups of ``SCORE_NODES``
    nodes; a forest of more nodes takes several passes.
    """
    spark = df.sparkSession
    ship_package(spark)
    limits, features, trees = model.limits, model.features, model.params.trees
    out = spread(df).withColumnRenamed(DEFAULTS.label, TRUTH).withColumn("fraud_probability", F.lit(0.0))
    names = out.columns

    def adding(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = np.zeros((len(batch), len(features)), np.uint8)
                for k, name in enumerate(features):
                    value = batch[name].cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
                    codes[:, k] = np.where(np.isnan(value), 0, np.searchsorted(limits[k], value, "left"))
                total = np.asarray(batch["fraud_probability"]) + shared.value.shares(codes) / trees
                yield pa.RecordBatch.from_arrays([pa.array(total) if c == "fraud_probability" else batch[c] for c in names], names)

        return run

    sizes = model.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).orderBy("tree").collect()  # one row for each tree
    group, held = [], 0
    for k, tree in enumerate(sizes):
        group.append(tree["tree"])
        held += tree["n"]
        if held > SCORE_NODES or k + 1 == len(sizes):
            part = model.nodes.where(F.col("tree").between(group[0], group[-1])).select("tree", "node", "feature", "code", "p").toArrow()
            out = out.mapInArrow(adding(spark.sparkContext.broadcast(_Trees(part))), out.schema)
            group, held = [], 0
            if k + 1 < len(sizes):
                out = checkpointed(out)
    return out.withColumn("is_fraud", (F.col("fraud_probability") >= model.threshold).cast("int"))


def fit(
    df: DataFrame,
    label: str = DEFAULTS.label,
    features: Sequence[str] = FEATURES,
    params: ForestParams = ForestParams(),
) -> ForestModel:
    """Fit with given parameters, then choose the probability threshold with the best training F1."""
    model = _train(df, label, features, params)
    scored = score(df.withColumnRenamed(label, DEFAULTS.label), model)
    model.threshold = best_threshold(threshold_sweep(scored, TRUTH, "fraud_probability"))
    return model


def _fold_rows(folds: DataFrame, label: str, features: Sequence[str]) -> tuple[DataFrame, list[grow.Job], list[tuple[int, int]]]:
    """Binned rows of ``repeated_folds`` output, one each, and a job for each fold. Bins come from all rows, as the scaler does."""
    known = folds.where(F.col(label).isNotNull()).withColumn("row", _key(folds, features))
    places = known.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("repeat", "fold"))), lambda x: x["fold"]).alias("places"))
    first = known.agg(F.min("repeat")).first()[0]
    once = known.where(F.col("repeat") == first).select("row", F.col(label).cast("int").alias("fraud"), *features).join(places, "row")
    limits = grow.bin_limits(once, features)
    rows = checkpointed(grow.binned(spread(once), features, limits, ("row", "fraud", "places")))
    shape = known.agg(F.count_distinct("repeat").alias("repeats"), F.max("fold").alias("last"), F.min("repeat").alias("first")).first()
    jobs = grow.jobs_of(rows, shape["repeats"], shape["last"] + 1)
    return rows, jobs, [(j.repeat + shape["first"], j.fold) for j in jobs]


def _probabilities(shares: DataFrame, jobs: list[grow.Job], bands: Sequence[int], points: int) -> DataFrame:
    """``job, row, fraud, point, p``: the held-out probability for each prefix of trees and each cut; ``point`` counts prefixes first."""
    grouped = shares.groupBy("job", "row", "fraud").agg(F.collect_list(F.struct("band", "shares")).alias("parts"))

    def upto(band: int, trees: int) -> Column:
        parts = F.filter("parts", lambda x: x["band"] <= band)
        place = F.sequence(F.lit(0), F.lit(points - 1))
        return F.transform(place, lambda k: F.aggregate(parts, F.lit(0.0), lambda total, x: total + F.get(x["shares"], k)) / trees)

    prefixes = [upto(band, trees) for band, trees in enumerate(bands)]
    return grouped.select("job", "row", "fraud", F.posexplode(F.flatten(F.array(*prefixes))).alias("point", "p"))


def _fold_metrics(found: DataFrame) -> DataFrame:
    """``job, point, accuracy, precision, recall, f1_score`` at probability 0.5."""
    hit, bad = F.col("p") >= 0.5, F.col("fraud") == 1
    counts = found.groupBy("job", "point").agg(
        F.count_if(hit & bad).alias("tp"), F.count_if(hit & ~bad).alias("fp"), F.count_if(~hit & bad).alias("fn"), F.count_if(~hit & ~bad).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "job",
        "point",
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def _fold_auc(found: DataFrame) -> DataFrame:
    """``job, roc_auc``: ties count half; null where a class is missing."""
    counts = found.groupBy("job", "p").agg(F.count_if(F.col("fraud") == 1).alias("pos"), F.count_if(F.col("fraud") == 0).alias("neg"))
    curve = running_totals(checkpointed(counts), "p", ["neg"], ["job"])
    area = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0))
    return curve.groupBy("job").agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def cross_validate(
    folds: DataFrame,
    label: str = DEFAULTS.label,
    features: Sequence[str] = FEATURES,
    params: ForestParams = ForestParams(),
    metrics: Sequence[str] = CV_METRICS,
) -> list[dict]:
    """One dict per (repeat, fold) with the held-out metrics at probability 0.5; all folds' forests grow in one job.

    ``folds`` is ``repeated_folds`` output, best stored or checkpointed. Bins are made once from all rows.
    """
    rows, jobs, places = _fold_rows(folds, label, features)
    shares = grow.held_out_shares(rows, jobs, _rules(params), [params.trees], [params.depth], [params.min_split])
    found = checkpointed(_probabilities(shares, jobs, [params.trees], 1))
    table = _fold_metrics(found)
    if "roc_auc" in metrics:
        table = null_safe_join(table, _fold_auc(found), ["job"])
    lines = {r["job"]: r.asDict() for r in table.collect()}  # one row for each fold
    out = []
    for job, (repeat, fold) in zip(jobs, places):
        if job.number in lines:
            out.append({"repeat": repeat, "fold": fold, **{m: lines[job.number][m] for m in CV_METRICS if m in metrics}})
    return out


def fold_table(spark: SparkSession, results: list[dict]) -> DataFrame:
    """Fold scores in long form: ``repeat, fold, metric, value``."""
    rows = [
        (r["repeat"], r["fold"], m, None if r[m] is None else float(r[m])) for r in results for m in CV_METRICS if m in r
    ]
    return spark.createDataFrame(rows, "repeat int, fold int, metric string, value double")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population standard deviation per metric."""
    return folds.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("folds")
    )


def grid_points(grid: dict[str, list]) -> list[ForestParams]:
    names = ("trees", "depth", "min_split")
    return [ForestParams(**dict(zip(names, point))) for point in itertools.product(*[grid[n] for n in names])]


def grid_search(
    folds: DataFrame,
    grid: dict[str, list],
    label: str = DEFAULTS.label,
    features: Sequence[str] = FEATURES,
) -> list[tuple[ForestParams, float]]:
    """Mean held-out F1 of class 1 per parameter point, best first (ties keep grid order).

    Each fold grows the largest forest of the grid once; its prefixes and cuts are the other points.
    """
    rows, jobs, _ = _fold_rows(folds, label, features)
    bands, depths, splits = sorted(set(grid["trees"])), grid["depth"], grid["min_split"]
    deepest = None if None in depths else max(depths)
    shares = grow.held_out_shares(rows, jobs, grow.Rules(bands[-1], deepest, min(splits), ForestParams().seed), bands, depths, splits)
    metrics = _fold_metrics(_probabilities(shares, jobs, bands, len(depths) * len(splits)))
    means = {r["point"]: r["f1"] for r in metrics.groupBy("point").agg(F.avg("f1_score").alias("f1")).collect()}
    found = []
    for params in grid_points(grid):
        place = bands.index(params.trees) * len(depths) * len(splits) + depths.index(params.depth) * len(splits) + splits.index(params.min_split)
        found.append((params, means[place]))
    return sorted(found, key=lambda pair: -pair[1])


def grid_table(spark: SparkSession, found: list[tuple[ForestParams, float]]) -> DataFrame:
    rows = [(i + 1, p.trees, p.depth, p.min_split, float(f1)) for i, (p, f1) in enumerate(found)]
    return spark.createDataFrame(rows, "place int, trees int, depth int, min_split int, mean_f1 double")


def importances(spark: SparkSession, model: ForestModel) -> DataFrame:
    """``feature, importance`` (4 places), highest first: impurity removed by a feature's splits, as shares, mean over the trees."""
    splits = model.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    whole = splits.groupBy("tree").agg(F.sum("gain").alias("whole")).where("whole > 0")
    shares = splits.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("gain") / F.col("whole")).alias("share"))
    values = {r["feature"]: r["share"] for r in shares.collect()}  # one row for each feature
    total = sum(values.values()) or 1.0
    rows = sorted(((round(values.get(k, 0.0) / total, 4), f) for k, f in enumerate(model.features)), key=lambda r: (-r[0], r[1]))
    return spark.createDataFrame([(f, v) for v, f in rows], "feature string, importance double")


def evaluation(model: ForestModel, tested: DataFrame, folds: DataFrame | None = None, ranking: DataFrame | None = None) -> dict[str, DataFrame]:
    """What is kept next to a forest: importances, the report on ``tested`` (scored, with ``truth``), fold scores, grid ranking."""
    parts = {
        "importances": importances(tested.sparkSession, model),
        "report": classification_report(tested, TRUTH, "is_fraud"),
    }
    return parts | {name: table for name, table in (("folds", folds), ("grid", ranking)) if table is not None}


def save(model: ForestModel, spark: SparkSession, path: str, parts: dict[str, DataFrame] | None = None) -> None:
    """Write the forest and its ``parts`` (see ``evaluation``) to a new folder, then publish that by one row under ``path/state``.

    A job that is lost on the way leaves the last published version as it was; the newest row counts.
    """
    version, folder = 1, uuid.uuid4().hex
    if path_exists(spark, f"{path}/state"):
        version += spark.read.parquet(f"{path}/state").agg(F.max("version")).first()[0]
    tables = {"nodes": model.nodes, **(parts or model.parts)}
    for name, table in tables.items():
        table.write.parquet(f"{path}/{folder}/{name}")
    state = {
        "features": model.features,
        "means": model.scaler.means,
        "stds": model.scaler.stds,
        "limits": model.limits,
        "params": asdict(model.params),
        "threshold": model.threshold,
        "parts": [name for name in tables if name != "nodes"],
    }
    pointer = spark.createDataFrame([(version, folder, json.dumps(state))], "version long, folder string, state string")
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/state")


def load(spark: SparkSession, path: str) -> ForestModel:
    newest = spark.read.parquet(f"{path}/state").orderBy(F.desc("version"), "folder").first()
    state, folder = json.loads(newest["state"]), f"{path}/{newest['folder']}"
    features = tuple(state["features"])
    scaler = Scaler(features, tuple(state["means"]), tuple(state["stds"]))
    nodes = spark.read.parquet(f"{folder}/nodes")
    parts = {name: spark.read.parquet(f"{folder}/{name}") for name in state["parts"]}
    return ForestModel(features, scaler, state["limits"], nodes, ForestParams(**state["params"]), state["threshold"], parts)
