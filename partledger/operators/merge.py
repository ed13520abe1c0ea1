"""Joining the assessor's and the repairer's rows of a claim.

The join is many-to-many: s survey rows and g garage rows of one claim give s*g merged rows. Only the merged
table itself needs those rows. Features, baskets and similarity read survey columns alone, so they use
``matched_survey``: each survey row once, with the number of merged rows it stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from partledger.config import DEFAULTS
from partledger.functions.columns import resolve_column
from partledger.functions.text import clean_text, normalise_key
from partledger.operators.ordering import exact_quantile, hash_order, hash_totals
from partledger.session import checkpointed

FANOUT = "fanout"
FEW_ROWS = 100_000  # samples up to here are picked from the first rows of each task


def clean_claims(df: DataFrame, part: str, keys: Sequence[str] = DEFAULTS.merge_keys) -> DataFrame:
    """Cleaned part names and text keys, for the columns that exist."""
    changes = {k: normalise_key(F.col(k)) for k in keys if k in df.columns}
    if part in df.columns:
        changes[part] = clean_text(F.col(part))
    return df.withColumns(changes) if changes else df


def _shared_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[str]:
    shared = [k for k in keys if k in left.columns and k in right.columns]
    if not shared:
        raise ValueError(f"no common merge keys: {left.columns} and {right.columns}")
    return shared


def _text_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: F.coalesce(F.col(k), F.lit("nan")) for k in keys})


def merge_claims(
    surveyor: DataFrame,
    garage: DataFrame,
    keys: Sequence[str] = DEFAULTS.merge_keys,
    amount: str = DEFAULTS.amount,
    null_keys_match: bool = False,
    require_rows: bool = False,
) -> DataFrame:
    """Inner join on every key both sides have; same-named columns get ``_survey`` / ``_garage``.

    The first amount column, the survey one, is then called ``amount``. Null keys do not match unless
    ``null_keys_match`` asks for it. A claim with very many rows on both sides is split by Spark's skew join.
    """
    shared = _shared_keys(surveyor, garage, keys)
    if null_keys_match:
        surveyor, garage = _text_nulls(surveyor, shared), _text_nulls(garage, shared)
    overlap = [c for c in surveyor.columns if c in garage.columns and c not in shared]
    left = surveyor.withColumnsRenamed({c: f"{c}_survey" for c in overlap})
    right = garage.withColumnsRenamed({c: f"{c}_garage" for c in overlap})
    merged = left.join(right, shared, "inner")
    if amount not in merged.columns:
        found = [c for c in merged.columns if amount.upper() in c.upper()]
        if found:
            merged = merged.withColumnRenamed(found[0], amount)
    if require_rows and merged.isEmpty():
        raise ValueError("the merge is empty: the two tables share no claim")
    return merged


def matched_survey(
    surveyor: DataFrame,
    garage: DataFrame,
    keys: Sequence[str] = DEFAULTS.merge_keys,
    null_keys_match: bool = False,
) -> DataFrame:
    """Survey rows that find a garage row, with ``fanout`` = number of garage rows for their keys."""
    shared = _shared_keys(surveyor, garage, keys)
    if null_keys_match:
        surveyor, garage = _text_nulls(surveyor, shared), _text_nulls(garage, shared)
    counts = garage.groupBy(*shared).agg(F.count(F.lit(1)).alias(FANOUT))
    return surveyor.join(counts, shared, "inner")


def amount_cap(df: DataFrame, amount: str, weight: str | None = None) -> float:
    """``max(10 * p99, 100000)`` of a stored table; computed at once, so that the filter is a plain constant."""
    p99 = exact_quantile(df, amount, DEFAULTS.cap_quantile, weight)
    return max((p99 or 0.0) * DEFAULTS.cap_factor, DEFAULTS.cap_floor)


def filter_amount_cap(
    df: DataFrame, amount: str | None = None, weight: str | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Drop rows above the cap; rows without an amount go as well. No amount column, no filter.

    ``counted`` is a stored table with the same amounts, maybe in fewer rows that each stand for ``weight``; the cap comes
    from it, without it from ``df``, whose amounts are stored for that.
    """
    if amount is None:
        try:
            amount = resolve_column(df, "AMOUNT", preferred=[DEFAULTS.amount])
        except ValueError:
            return df
    if counted is None:
        counted = checkpointed(df.select(amount, *([weight] if weight else [])))
    return df.where(F.col(amount) <= amount_cap(counted, amount, weight))


def claim_rows(
    surveyor: DataFrame, garage: DataFrame, amount: str = DEFAULTS.amount, keep: Sequence[str] | None = None
) -> DataFrame:
    """The usual input of features, baskets and similarity: matched, capped survey rows with ``fanout``.

    The join runs once and is stored; the cap is then found and applied on the stored rows. ``keep`` names the columns
    that the caller reads; then no others travel.
    """
    if keep is None:
        rows = checkpointed(matched_survey(surveyor, garage))
    else:
        kept = list(dict.fromkeys([*keep, amount]))
        keys = [k for k in DEFAULTS.merge_keys if k in surveyor.columns and k not in kept]
        rows = checkpointed(matched_survey(surveyor.select(*keys, *kept), garage).select(*kept, FANOUT))
    return filter_amount_cap(rows, amount, FANOUT, rows)


def sample_n(df: DataFrame, n: int | None, seed: int = DEFAULTS.seed) -> DataFrame:
    """Exactly ``n`` rows, chosen by a hash of the whole row; no-op unless ``0 < n < rows``.

    Equal rows are counted before they are ordered, so a heavily repeated row is one entry.
    """
    if n is None or n <= 0:
        return df
    image = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    if n <= FEW_ROWS:  # each distinct row stands for one row at least
        distinct = checkpointed(distinct.orderBy(hash_order(image, seed)).limit(n))
    ranked = hash_totals(distinct, image, "_copies", seed=seed, name="_upto")
    kept = F.least(F.col("_copies"), F.lit(n) - (F.col("_upto") - F.col("_copies")))
    taken = ranked.withColumn("_kept", kept).where("_kept > 0")
    return taken.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "_kept"))).select(*df.columns)
