"""Null-safe change predicates."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column


def differs(left: Column, right: Column) -> Column:
    """True when the values differ, counting NULL against a value as a difference."""
    return ~left.eqNullSafe(right)


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when at least one pair differs."""
    return reduce(or_, (differs(left, right) for left, right in pairs))
