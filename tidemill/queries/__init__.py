"""Queries of the market-data engine over the test tables."""

from tidemill.queries import cleaning, factors, sources, validation  # noqa: F401
from tidemill.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
