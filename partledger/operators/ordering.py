"""Exact ranks, running totals and quantiles that never gather a table in one task.

A window without a partition key would sort the whole table in a single task. Here rows go to a bounded
number of value ranges; per-range totals give each range its starting offset, and the window runs inside
the ranges only. Results are exact: the range limits come from an approximate quantile sketch, but they
decide only where rows are processed.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from partledger.session import checkpointed

MAX_RANGES = 4096  # the offset table has at most this many rows per group
HASH_BITS = 12  # hash ranks use 2**12 ranges; md5 is uniform, so they are even
BINS = 4096  # of a span of values, for quantiles
FEW_VALUES = 100_000  # up to here the rows near a quantile are counted value by value
MAX_ROUNDS = 3


def null_safe_join(df: DataFrame, table: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the other columns of ``table`` (one row per ``by``) to ``df``; null is a key like any other."""
    renamed = table.withColumnsRenamed({c: f"_by_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return df.join(renamed, same).drop(*[f"_by_{c}" for c in by])


def _offsets(ranged: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sum of all earlier ranges, per range."""
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    shifts = [F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums]
    return totals.select(*by, "_range", *shifts)


def _ranged(df: DataFrame, key: str) -> DataFrame:
    """Add ``_range``: where ``key`` falls among evenly spaced approximate quantiles."""
    wanted = max(2, min(MAX_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    limits = df.approxQuantile(key, [i / wanted for i in range(1, wanted)], 0.25 / wanted)
    splits = [-math.inf, *sorted(set(limits)), math.inf]
    if len(splits) < 3:
        return df.withColumn("_range", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=key, outputCol="_range").transform(df)


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<s>``, the running sum of each column of ``sums`` along ``order``.

    ``order`` has to be unique inside a ``by`` group (aggregate first); ``by`` groups must be few. ``df`` is
    read more than once, so it should be a checkpointed or stored table.
    """
    key = F.col(order).cast("double")
    keyed = df.withColumn("_key", -key if descending else key)
    ranged = _ranged(keyed, "_key")
    inside = Window.partitionBy(*by, "_range").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = null_safe_join(ranged, F.broadcast(_offsets(ranged, by, sums)), [*by, "_range"])
    for s in sums:
        placed = placed.withColumn(f"cum_{s}", F.col(f"_o_{s}") + F.sum(s).over(inside))
    return placed.drop("_key", "_range", *[f"_o_{s}" for s in sums])


def _near_counts(known: DataFrame, probabilities: Sequence[float], by: Sequence[str]) -> DataFrame:
    """``by…, _value, _n``: counts of the distinct values near the wanted places, of each bin of other values under its largest.

    Values go to bins of equal width over each group's span. A bin that no wanted place falls into needs its count alone;
    the others are cut again while they hold many rows. Totals up to any value near a place are those over all rows.
    """
    near, done, spans, rows = known.withColumn("_span", F.lit(0)), [], 0, known.count()
    bins = Window.partitionBy(*by).orderBy("_high").rowsBetween(Window.unboundedPreceding, 0)
    while rows > FEW_VALUES and spans < MAX_ROUNDS:
        spans += 1
        ends = near.groupBy(*by, "_span").agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"))
        width = (F.col("_high") - F.col("_low")) / BINS
        ends = checkpointed(ends.select(*by, "_span", "_low", width.alias("_width")))
        # Spans without a width (one value, or an infinite one) are one bin.
        wide = (F.col("_width") > 0) & (F.col("_width") < math.inf)
        place = F.when(wide, F.least(F.floor((F.col("_value") - F.col("_low")) / F.col("_width")), F.lit(BINS - 1))).otherwise(F.lit(0))
        binned = null_safe_join(near, F.broadcast(ends), [*by, "_span"]).withColumn("_bin", place.cast("int")).drop("_low", "_width")
        listed = binned.groupBy(*by, "_span", "_bin").agg(
            F.count(F.lit(1)).alias("_rows"), F.sum("_n").alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_high")
        )  # at most BINS rows a span
        for d in done:
            closed = {"_span": F.lit(-1), "_bin": F.lit(0), "_rows": F.lit(0), "_least": F.col("_value"), "_high": F.col("_value")}
            listed = listed.unionByName(d.withColumns(closed).drop("_value"))
        upto, total = F.sum("_n").over(bins), F.sum("_n").over(Window.partitionBy(*by))
        listed = listed.withColumn("_upto", upto).withColumn("_total", total)
        wanted = F.lit(False)
        for p in probabilities:
            at = (F.col("_total") - 1) * F.lit(float(p))
            for x in (F.floor(at), F.ceil(at)):
                wanted |= (F.col("_upto") > x) & (F.col("_upto") - F.col("_n") <= x)
        listed = checkpointed(listed.withColumn("_open", wanted & (F.col("_rows") > 0) & (F.col("_least") < F.col("_high"))))
        done = [listed.where("NOT _open").select(*by, F.col("_high").alias("_value"), "_n")]
        places = F.xxhash64(F.lit(spans), "_span", "_bin").alias("_next")  # a name for the new span
        opened = listed.where("_open").select(*by, "_span", "_bin", places)
        near = null_safe_join(binned, F.broadcast(opened), [*by, "_span", "_bin"]).select(*by, "_value", "_n", F.col("_next").alias("_span"))
        rows = listed.where("_open").agg(F.sum("_rows")).first()[0] or 0
    counted = near.groupBy(*by, "_value").agg(F.sum("_n").alias("_n"))
    return functools.reduce(DataFrame.unionByName, [counted, *done])


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    weight: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles, one row per ``by`` group, one column per named probability.

    ``weight`` says how many rows each row stands for. ``by`` groups must be few (classes, features). ``df`` is read
    more than once, so it should be a checkpointed or stored table: only values near the wanted places are counted one
    by one, running totals then find the places.
    """
    share = F.col(weight) if weight else F.lit(1)
    known = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_value"), share.cast("long").alias("_n"))
    counts = checkpointed(_near_counts(known, list(probabilities.values()), by))
    ranked = running_totals(counts, "_value", ["_n"], by)
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    if by:
        ranked = null_safe_join(ranked, totals, by)
    else:
        ranked = ranked.withColumn("_total", totals.scalar())

    def order_statistic(position: Column) -> Column:
        return F.min(F.when(F.col("cum__n") > position, F.col("_value")))

    picks, results = [], []
    for name, p in probabilities.items():
        place = (F.col("_total") - 1) * F.lit(float(p))
        picks += [
            order_statistic(F.floor(place)).alias(f"_lo_{name}"),
            order_statistic(F.ceil(place)).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_part_{name}"),
        ]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        part = F.col(f"_part_{name}")
        results.append(F.when(part == 0, low).otherwise((1 - part) * low + part * high).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *results)


def exact_quantile(
    df: DataFrame, value: str, p: float, weight: str | None = None
) -> float | None:
    """One quantile of a column as a number (null for no values); runs at once."""
    return exact_quantiles(df, value, {"q": p}, weight).first()["q"]


def hash_order(key: Column, seed: int | str = "") -> Column:
    """A repeatable pseudo-random order: the md5 of the key, 32 hex digits."""
    text = key.cast("string")
    return F.md5(F.concat(F.lit(f"{seed}|"), text) if seed != "" else text)


def hash_ranged(df: DataFrame, key: Column, seed: int | str = "") -> DataFrame:
    """Add ``_hash`` and the range it falls in, ``_range``."""
    first = F.conv(F.substring("_hash", 1, HASH_BITS // 4), 16, 10).cast("int")
    return df.withColumn("_hash", hash_order(key, seed)).withColumn("_range", first)


def hash_totals(
    df: DataFrame, key: Column, amount: str, by: Sequence[str] = (), seed: int | str = "", name: str = "total"
) -> DataFrame:
    """Running sum of ``amount`` inside each ``by`` group, in hash order of a unique ``key``.

    ``by`` groups must be few, but each may hold any share of the rows.
    """
    ranged = hash_ranged(df, key, seed)
    inside = Window.partitionBy(*by, "_range").orderBy("_hash").rowsBetween(Window.unboundedPreceding, 0)
    counted = ranged.withColumn("_inside", F.sum(amount).over(inside))
    return (
        null_safe_join(counted, F.broadcast(_offsets(ranged, by, [amount])), [*by, "_range"])
        .withColumn(name, F.col(f"_o_{amount}") + F.col("_inside"))
        .drop("_hash", "_range", "_inside", f"_o_{amount}")
    )


def hash_rank(
    df: DataFrame, key: Column, by: Sequence[str] = (), seed: int | str = "", name: str = "rank"
) -> DataFrame:
    """Number the rows 1, 2, … inside each ``by`` group in hash order of a unique ``key``."""
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    return hash_totals(counted, key, "_one", by, seed, name).drop("_one")


def hash_sample(df: DataFrame, key: Column, size: int, rows: int, seed: int | str = "") -> DataFrame:
    """Up to ``size`` of ``rows`` rows, those first in hash order of a unique ``key``.

    A filter on the hash keeps little more than ``size`` rows before they are ordered. ``size`` has to be small.
    """
    order = hash_order(key, seed)
    if rows > size:
        share = (size + 6 * math.sqrt(size) + 64) / rows  # six standard deviations of spare
        place = F.conv(F.substring(order, 1, 13), 16, 10).cast("double") / float(2**52)
        df = df.where(place < share)
    return df.withColumn("_order", order).orderBy("_order").limit(size).drop("_order")
