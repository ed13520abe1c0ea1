"""Nine numbers per claim, and the claim-level fraud label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from partledger.config import DEFAULTS, FEATURES
from partledger.functions.columns import resolve_column


def _derived(base: DataFrame) -> DataFrame:
    """Range, variation and log from the six aggregates."""
    spread, mean = F.col("std_part_amount"), F.col("avg_part_amount")
    return base.withColumns(
        {
            "amount_range": F.col("max_part_amount") - F.col("min_part_amount"),
            "coeff_variation": F.when(mean > 0, spread / mean).otherwise(F.lit(0.0)),
            "log_total_amount": F.log1p("total_amount"),
        }
    )


def claim_features(
    rows: DataFrame,
    weight: str | None = None,
    claim: str = DEFAULTS.claim_id,
    amount: str | None = None,
    label: str | None = None,
) -> DataFrame:
    """Aggregate rows to claims.

    ``rows`` is the merged table, or matched survey rows with ``weight`` = their fan-out; both give the same
    result, the second without ever building the fan-out. ``label`` adds its per-claim maximum (null = 0).
    """
    amount = amount or resolve_column(rows, "AMOUNT", preferred=[DEFAULTS.amount])
    known = rows.where(F.col(claim).isNotNull())
    x = F.col(amount).cast("double")
    flag = [F.max(label).alias(label)] if label else []
    if weight is None:
        base = known.groupBy(claim).agg(
            F.coalesce(F.sum(x), F.lit(0.0)).alias("total_amount"),
            F.count(x).alias("part_count"),
            F.avg(x).alias("avg_part_amount"),
            F.max(x).alias("max_part_amount"),
            F.min(x).alias("min_part_amount"),
            F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("std_part_amount"),
            *flag,
        )
    else:
        base = _weighted(known, claim, weight, x, flag)
    features = _derived(base)
    if label:
        features = features.withColumn(label, F.coalesce(F.col(label), F.lit(0)).cast("int"))
    return features.select(claim, *FEATURES, *([label] if label else []))


def _weighted(rows: DataFrame, claim: str, weight: str, x: Column, flag: list[Column]) -> DataFrame:
    """The six aggregates over rows that each stand for ``weight`` equal rows.

    Deviations are summed around the mean of each (claim, weight) group; the part between groups is exactly
    zero when all of them share one mean, as with the usual single group.
    """
    w = F.col(weight)
    groups = rows.groupBy(claim, weight).agg(
        F.sum(x).alias("_s"),
        F.count(x).alias("_n"),
        F.avg(x).alias("_m"),
        (F.var_pop(x) * F.count(x)).alias("_d"),
        F.max(x).alias("_max"),
        F.min(x).alias("_min"),
        *flag,
    )
    count, mean = F.col("part_count"), F.col("avg_part_amount")
    between = F.when(F.col("_m_low") == F.col("_m_high"), F.lit(0.0)).otherwise(
        F.greatest(F.col("_square") - count * mean * mean, F.lit(0.0))
    )
    return (
        groups.groupBy(claim)
        .agg(
            F.coalesce(F.sum(w * F.col("_s")), F.lit(0.0)).alias("total_amount"),
            F.sum(w * F.col("_n")).alias("part_count"),
            F.max("_max").alias("max_part_amount"),
            F.min("_min").alias("min_part_amount"),
            F.sum(w * F.col("_d")).alias("_within"),
            F.sum(w * F.col("_n") * F.col("_m") * F.col("_m")).alias("_square"),
            F.min("_m").alias("_m_low"),
            F.max("_m").alias("_m_high"),
            *[F.max(c).alias(c) for c in groups.columns if c not in {claim, weight} and not c.startswith("_")],
        )
        .withColumn("avg_part_amount", F.try_divide(F.col("total_amount"), count))
        .withColumn(
            "std_part_amount",
            F.coalesce(F.sqrt(F.try_divide(F.col("_within") + between, count - 1)), F.lit(0.0)),
        )
    )


def attach_labels(
    features: DataFrame, rows: DataFrame, claim: str = DEFAULTS.claim_id, label: str = DEFAULTS.label
) -> DataFrame:
    """Left-join the per-claim maximum of the label; claims without one get 0. No label column, no change."""
    if label not in rows.columns:
        return features
    labels = rows.groupBy(claim).agg(F.max(label).alias(label))
    joined = features.join(labels, claim, "left")
    return joined.withColumn(label, F.coalesce(F.col(label), F.lit(0)).cast("int"))


def quote_features(quotes: DataFrame) -> DataFrame:
    """Features for a claim known only by ``total_amount`` and ``part_count``; other columns are kept."""
    total = F.col("total_amount").cast("double")
    count = F.coalesce(F.col("part_count"), F.lit(1)).cast("long")
    mean = total / F.greatest(count, F.lit(1))
    return quotes.withColumns(
        {
            "total_amount": total,
            "part_count": count,
            "avg_part_amount": mean,
            "max_part_amount": total,
            "min_part_amount": mean,
            "std_part_amount": F.lit(0.0),
            "amount_range": F.when(count > 1, total - mean).otherwise(F.lit(0.0)),
            "coeff_variation": F.lit(0.0),
            "log_total_amount": F.log1p(total),
        }
    )
