"""Spark DataFrame jobs for vehicle-repair claims: cleaning, matching, mining, similarity and fraud scoring."""

from partledger.config import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
