"""Queries over the supplied tables. Importing this package registers all of them."""

from tierkeep.queries import activity, history, landing, market, tiers  # noqa: F401
from tierkeep.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
