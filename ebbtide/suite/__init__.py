"""Runnable queries over the star-schema test tables, each with its SQL where SQL can say it."""

from ebbtide.suite import changes, checks, profiles, relational, state, streams  # noqa: F401  (register their queries)
from ebbtide.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
