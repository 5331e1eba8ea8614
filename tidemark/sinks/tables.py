"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.union import align


def append_rows(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT …``, matched by column name instead of position."""
    align(df, df.sparkSession.table(table)).write.insertInto(table)
