"""All registered queries and their SQL."""

from partledger.plans import catalog_models, catalog_tables  # noqa: F401  (registering)
from partledger.plans.registry import BUILDERS, ORACLES

__all__ = ["BUILDERS", "ORACLES"]
