"""Registered queries over the TPC-H-like tables, each beside the SQL it must agree with."""

from tidemark.queries import cdc, quality, relational, revenue, scalars, scd, star  # noqa: F401
from tidemark.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
