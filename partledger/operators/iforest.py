"""Isolation forest (Liu, Ting, Zhou 2008): trees grown per group, rows scored in batches.

Every tree sees a small sample, so the fitted forest has a fixed size (trees * 2 * sample nodes) whatever the
table holds, and can travel to the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from partledger.config import DEFAULTS, FEATURES, TRUTH
from partledger.operators.blocks import parallelism, spread
from partledger.operators.ordering import exact_quantile, hash_rank
from partledger.operators.sampling import Scaler, apply_scaler, fit_scaler
from partledger.session import checkpointed

NODES = "tree int, node int, feature int, split double, left int, right int, path double"


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    far = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, far))


@dataclass
class IForestModel:
    features: tuple[str, ...]
    scaler: Scaler
    sample: int
    offset: float
    nodes: pd.DataFrame = field(repr=False)


def _grow(columns: Sequence[str], depth_limit: int, seed: int):
    """Grow one tree from its sample: random feature, uniform random split, until alone or deep enough."""

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        random = np.random.default_rng([seed, tree])
        x = rows.sort_values("draw")[list(columns)].to_numpy(dtype=float)
        out: list[list] = []
        waiting = [(0, np.arange(len(x)), 0)]
        out.append([tree, 0, -1, 0.0, -1, -1, 0.0])
        while waiting:
            node, members, depth = waiting.pop()
            part = x[members]
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= depth_limit or len(members) <= 1 or not len(usable):
                out[node][6] = depth + float(expected_path(len(members)))
                continue
            feature = int(random.choice(usable))
            split = float(random.uniform(low[feature], high[feature]))
            goes_left = part[:, feature] <= split
            left, right = len(out), len(out) + 1
            out[node][2:6] = [feature, split, left, right]
            for child, chosen in ((left, goes_left), (right, ~goes_left)):
                out.append([tree, child, -1, 0.0, -1, -1, 0.0])
                waiting.append((child, members[chosen], depth + 1))
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in NODES.split(", ")])

    return grow


def fit(
    df: DataFrame,
    key: str = DEFAULTS.claim_id,
    features: Sequence[str] = FEATURES,
    trees: int = DEFAULTS.iso_trees,
    sample: int = DEFAULTS.iso_samples,
    contamination: float = DEFAULTS.contamination,
    seed: int = DEFAULTS.seed,
) -> IForestModel:
    """Fit on the rows of ``df``; ``key`` is unique and only decides which rows are drawn.

    Draws are with replacement, each from all rows: the rows are numbered in hash order and the drawn numbers joined.
    """
    scaler = fit_scaler(df, features)
    scaled = apply_scaler(df.select(key, *features), scaler)
    rows = df.count()
    if rows == 0:
        raise ValueError("no rows to fit an isolation forest on")
    sample = min(sample, rows)
    numbered = hash_rank(scaled, F.col(key), seed=seed, name="_rank").withColumn("place", F.col("_rank") - 1).drop(key, "_rank")
    spark = df.sparkSession
    draws = spark.range(trees * sample).select(
        (F.col("id") / sample).cast("int").alias("tree"),
        (F.col("id") % sample).cast("int").alias("draw"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(rows)).alias("place"),
    )
    depth_limit = int(np.ceil(np.log2(max(sample, 2))))
    nodes = (
        numbered.join(F.broadcast(draws), "place")  # trees * sample numbers, whatever the table holds
        .repartition(min(trees, parallelism(spark)), "tree")
        .groupBy("tree")
        .applyInPandas(_grow(features, depth_limit, seed), NODES)
        .toPandas()
        .sort_values(["tree", "node"], ignore_index=True)
    )
    model = IForestModel(tuple(features), scaler, sample, 0.0, nodes)
    raw = checkpointed(raw_scores(df, model).select("raw_score"))
    model.offset = exact_quantile(raw, "raw_score", contamination)
    return model


def _walkable(nodes: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    """Each tree as arrays ``feature, split, left, path, leaf``; a right child follows the left one, a leaf leads back to itself."""
    out = []
    for _, tree in nodes.groupby("tree"):
        feature, left = tree["feature"].to_numpy(), tree["left"].to_numpy()
        leaf = feature < 0
        split = np.where(leaf, np.inf, tree["split"].to_numpy())
        out.append((np.where(leaf, 0, feature), split, np.where(leaf, np.arange(len(leaf)), left), tree["path"].to_numpy(), leaf))
    return out


def _mean_path(x: np.ndarray, forest: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    total = np.zeros(len(x))
    flat = np.where(np.isnan(x), np.inf, x).ravel()  # a missing number goes right everywhere
    start = np.arange(len(x)) * x.shape[1]
    for feature, split, left, path, leaf in forest:
        at = np.zeros(len(x), dtype=np.int64)
        while not leaf[at].all():
            for _ in range(4):  # rows at a leaf stay there
                at = left[at] + (flat[start + feature[at]] > split[at])
        total += path[at]
    return total / len(forest)


def raw_scores(df: DataFrame, model: IForestModel) -> DataFrame:
    """Add ``raw_score`` = -2^(-mean path / expected path); lower is more anomalous."""
    shared = df.sparkSession.sparkContext.broadcast(_walkable(model.nodes))  # fixed size: trees * 2 * sample nodes
    norm = max(float(expected_path(model.sample)), 1e-12)
    scaled = [
        (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
        for c, m, s in zip(model.scaler.columns, model.scaler.means, model.scaler.stds)
    ]

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(-np.exp2(-_mean_path(x, shared.value) / norm))

    return spread(df).withColumn("raw_score", score(*scaled))


def score(df: DataFrame, model: IForestModel) -> DataFrame:
    """Add ``anomaly_score``, ``anomaly_label`` (-1 anomaly, 1 normal) and ``is_fraud``; a label becomes ``truth``."""
    shifted = F.col("raw_score") - F.lit(model.offset)
    return (
        raw_scores(df.withColumnRenamed(DEFAULTS.label, TRUTH), model)
        .withColumn("anomaly_score", shifted)
        .withColumn("anomaly_label", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))
        .withColumn("is_fraud", (F.col("anomaly_label") == -1).cast("int"))
        .drop("raw_score")
    )


def quote_status(scored: DataFrame) -> DataFrame:
    return scored.withColumn("status", F.when(F.col("is_fraud") == 1, "SUSPICIOUS").otherwise("NORMAL"))


def save(model: IForestModel, spark: SparkSession, path: str) -> None:
    """Nodes as one table, scaler and offset as another."""
    spark.createDataFrame(model.nodes, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    state = [
        (i, c, m, s, model.sample, model.offset)
        for i, (c, m, s) in enumerate(zip(model.scaler.columns, model.scaler.means, model.scaler.stds))
    ]
    schema = "place int, feature string, mean double, std double, sample int, offset double"
    spark.createDataFrame(state, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/state")


def load(spark: SparkSession, path: str) -> IForestModel:
    state = spark.read.parquet(f"{path}/state").toPandas().sort_values("place")
    nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"], ignore_index=True)
    columns = tuple(state["feature"])
    scaler = Scaler(columns, tuple(map(float, state["mean"])), tuple(map(float, state["std"])))
    return IForestModel(columns, scaler, int(state["sample"].iloc[0]), float(state["offset"].iloc[0]), nodes)
