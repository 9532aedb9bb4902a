"""Registered queries with the SQL they are checked against."""

from checks.registry import ORACLES, QUERIES
from checks import etl, explore, models, monitor, storage, streams  # noqa: F401  (register their queries)

__all__ = ["QUERIES", "ORACLES"]
