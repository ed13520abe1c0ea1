"""Splits, folds, scaling and class weights; all repeatable, none needs a global sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from partledger.config import DEFAULTS
from partledger.operators.ordering import hash_order, hash_rank, hash_ranged, null_safe_join


def stratified_split(
    df: DataFrame,
    key: str,
    label: str | None = DEFAULTS.label,
    ratio: float = DEFAULTS.test_ratio,
    seed: int | str = "",
) -> DataFrame:
    """Add ``split`` = train / test; exactly ``round(ratio * n)`` test rows per class; null is a class of its own.

    Rows are taken in md5 order of ``key``. Without a label column the whole table is one class.
    """
    by = [label] if label and label in df.columns else []
    ranged = hash_ranged(df, F.col(key), seed).withColumn("_range", F.coalesce("_range", F.lit(-1)))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_n").over(Window.partitionBy(*by))
    size = F.round(total * F.lit(ratio).cast("decimal(10,6)"), 0).cast("long")
    ranges = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n")).withColumns({"_upto": upto, "_limit": size})
    last = (F.col("_upto") >= F.col("_limit")) & (F.col("_upto") - F.col("_n") < F.col("_limit"))
    edges = ranges.groupBy(*by).agg(
        F.coalesce(F.max(F.when(last, F.col("_range"))), F.lit(-2)).alias("_edge"),
        F.max(F.when(last, F.col("_limit") - F.col("_upto") + F.col("_n"))).alias("_left"),
    )
    # One hash range of a class holds both kinds; only its rows are ordered.
    if by:
        placed = null_safe_join(ranged, F.broadcast(edges), by)
    else:
        placed = ranged.crossJoin(F.broadcast(edges))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_hash"))
    ordered = placed.where("_range = _edge").withColumn("_test", rank <= F.col("_left"))
    settled = placed.where("_range <> _edge").withColumn("_test", F.col("_range") < F.col("_edge"))
    split = F.when(F.col("_test"), "test").otherwise("train")
    return settled.unionByName(ordered).withColumn("split", split).select(*df.columns, "split")


def repeated_folds(
    df: DataFrame,
    key: str,
    label: str = DEFAULTS.label,
    splits: int = DEFAULTS.cv_splits,
    repeats: int = DEFAULTS.cv_repeats,
) -> DataFrame:
    """Every row once per repeat with its ``fold``; folds keep the class shares."""
    copies = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    order = F.concat_ws("|", F.col("repeat").cast("string"), F.col(key).cast("string"))
    ranked = hash_rank(copies, order, [label, "repeat"], name="_rank")
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % splits).cast("int")).drop("_rank")


def shuffle_rows(df: DataFrame, key: str, seed: int | str = DEFAULTS.seed) -> DataFrame:
    """A repeatable random order of the rows (Spark's range-partitioned sort)."""
    return df.orderBy(hash_order(F.col(key), seed))


@dataclass(frozen=True)
class Scaler:
    """Means and population standard deviations (1 where a column is constant)."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    numbers = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return Scaler(
        tuple(columns),
        tuple(numbers[f"m_{c}"] or 0.0 for c in columns),
        tuple(numbers[f"s_{c}"] or 1.0 for c in columns),
    )


def apply_scaler(df: DataFrame, scaler: Scaler, prefix: str = "") -> DataFrame:
    return df.withColumns(
        {
            f"{prefix}{c}": (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, m, s in zip(scaler.columns, scaler.means, scaler.stds)
        }
    )


def class_weights(df: DataFrame, label: str = DEFAULTS.label) -> DataFrame:
    """``n / (2 * class size)`` per class, as a two-row table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (2.0 * F.col("n")))
