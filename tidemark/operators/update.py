"""Updates as projections: a row keeps its place and only the named columns change."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """``UPDATE … SET … WHERE condition``. New values are computed from the old row.

    As in SQL, a condition that is NULL updates nothing.
    """
    return df.withColumns(
        {c: F.when(condition, value).otherwise(F.col(c)) for c, value in values.items()}
    )


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Column defaults, applied where a value is missing."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(kinds[c])) for c, v in defaults.items()}
    )
