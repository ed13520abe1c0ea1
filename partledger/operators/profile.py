"""Table profiles: gaps, duplicates, descriptive statistics, value shares."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from partledger.operators.ordering import exact_quantiles
from partledger.session import checkpointed

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns as ``(keep…, column_name, value)`` rows."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keep), list(columns), "column_name", "value")


def missing_values(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "missing")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier row in full."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def describe_table(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per numeric column (and ``by`` group)."""
    rows = checkpointed(long_form(df, columns, by))
    groups = [*by, "column_name"]
    basic = rows.groupBy(*groups).agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(rows, "value", QUARTILES, by=groups)
    return basic.join(quartiles, groups, "left").select(*groups, "n", "mean", "std", "min", *QUARTILES, "max")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation, strictly lower triangle, one row per pair; one pass over the table."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[:i]]
    numbers = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(a).alias("row_name"), F.lit(b).alias("column_name"), F.col(f"c{i}").alias("correlation"))
                for i, (a, b) in enumerate(pairs)
            ]
        )
    )
    return df.agg(*numbers).select(rows.alias("r")).select("r.*")


def value_counts(df: DataFrame, column: str, name: str, count: str = "count") -> DataFrame:
    """Rows per value, null left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias(name))
        .agg(F.count(F.lit(1)).alias(count))
    )


def common_parts(df: DataFrame, part: str) -> DataFrame:
    """``part_name, count, percentage`` of all parts, most frequent first."""
    counts = value_counts(df, part, "part_name")
    total = counts.select(F.sum("count")).scalar()
    share = F.round((F.col("count") / total * 100).cast("decimal(20,8)"), 2).cast("double")
    return counts.withColumn("percentage", share).orderBy(F.desc("count"), "part_name")


def primary_part_distribution(df: DataFrame, code: str) -> DataFrame:
    return value_counts(df, code, "primary_part_code", "claim_count").orderBy(
        F.desc("claim_count"), "primary_part_code"
    )


def class_balance(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Count and share of each class in each split; the window runs over class counts only."""
    from pyspark.sql import Window

    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(split)))


def rate_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and sample standard deviation of ``value`` per group."""
    return df.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
    )
