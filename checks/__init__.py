"""Queries over the given tables with the SQL that must give the same rows."""

from checks.registry import QUERIES, SQL
from checks import events, feeds, markup, orders, requests, runs, streams, timelines  # noqa: F401  (they register)

__all__ = ["QUERIES", "SQL"]
