"""Every operator as a query over the given tables, with the same result in plain SQL."""

from checks import aggregates, dashboard, functions, movement, sources, star, zones  # noqa: F401
from checks.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
