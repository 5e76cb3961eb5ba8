"""Queries over whole tables and the SQL they are checked against."""

from siltstone.checks.registry import ORACLES, QUERIES
from siltstone.checks import base, gold_checks, relational, silver_checks  # noqa: F401  (they register their queries)

__all__ = ["ORACLES", "QUERIES"]
