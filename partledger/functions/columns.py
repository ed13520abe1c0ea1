"""Finding columns by name at plan time; no job runs here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def resolve_column(df: DataFrame, keyword: str, exclude: str = "", preferred: Sequence[str] = ()) -> str:
    """First column whose name contains ``keyword`` and not ``exclude``; preferred names win."""

    def fits(name: str) -> bool:
        upper = name.upper()
        return keyword.upper() in upper and not (exclude and exclude.upper() in upper)

    known = [c for c in preferred if c in df.columns]
    for name in [*known, *df.columns]:
        if fits(name):
            return name
    raise ValueError(f"no column matching '{keyword}' among {df.columns}")
