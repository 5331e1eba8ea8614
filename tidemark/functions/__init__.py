"""Column expressions shared by the operators."""

from tidemark.functions.changes import any_differs, differs
from tidemark.functions.dates import date_key, day_name, day_of_week, instant
from tidemark.functions.keys import comparable, required, row_hash, surrogate_key, tie_break
from tidemark.functions.money import line_gross, line_net

__all__ = [
    "any_differs",
    "comparable",
    "date_key",
    "day_name",
    "day_of_week",
    "differs",
    "instant",
    "line_gross",
    "line_net",
    "required",
    "row_hash",
    "surrogate_key",
    "tie_break",
]
