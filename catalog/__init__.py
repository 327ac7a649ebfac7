"""Registered queries with the SQL that gives the same result, one per operator."""

from catalog import aggregates, filters, functions, jobs, joins, ordering, sources  # noqa: F401
from catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
