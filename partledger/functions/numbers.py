"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero, on a decimal image so that float noise cannot flip a tie."""
    return F.round(value.cast(f"decimal(30,{places + 4})"), places).cast("double")


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    """``top / bottom``, zero where the quotient is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
