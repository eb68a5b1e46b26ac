"""Registered queries: the warehouse over the given tables, with SQL to compare against."""

from catalog import checks, measures, models, operators, reports, staged, timeline  # noqa: F401 - each registers its queries
from catalog.registry import QUERIES as ALL

__all__ = ["ALL"]
