"""Named queries: a DataFrame builder per name, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partledger.plans.workspace import Workspace

BUILDERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(workspace) -> DataFrame`` under ``name``."""

    def register(build: Callable[[Workspace], DataFrame]):
        BUILDERS[name] = lambda spark, folder: build(Workspace.of(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
