"""Importing this package registers every query."""

from tallyspan.plans import aggregates, ordered, relational, scalars, streams  # noqa: F401
from tallyspan.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
