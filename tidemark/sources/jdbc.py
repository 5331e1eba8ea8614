"""JDBC source. Connection settings, credentials included, come from the caller."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Split:
    """Parallel read over a numeric, date or timestamp column.

    The bounds only set the stride: rows outside them go to the first or last partition,
    so none are lost. A column whose values bunch up is better split with
    ``equi_depth_predicates``.
    """

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def sql_literal(value) -> str:
    """A number, date or time as SQL text."""
    return f"'{value.isoformat(sep=' ') if hasattr(value, 'hour') else value.isoformat()}'" if isinstance(value, date) else str(value)


def equi_depth_predicates(keys: DataFrame, column: str, partitions: int, literal=sql_literal, accuracy: int = 10_000) -> list[str]:
    """Disjoint conditions that cover every row, NULLs too, with about equally many rows each.

    ``keys`` is a frame with the column: the landed rows of an earlier load, or a sample that
    the database drew. Its quantiles come from a sketch, so the driver gets ``partitions``
    numbers. A value that fills more than one share gets a condition of its own.
    """
    shares = [F.lit(i / partitions) for i in range(1, partitions)]
    found = keys.agg(F.percentile_approx(column, F.array(*shares), accuracy).alias("cuts")).first().cuts if shares else None
    times = Counter(found or [])
    conditions, lower = [], None  # lower: the condition that values beyond the last cut meet
    for cut in sorted(times):
        value = literal(cut)
        below = f"{column} < {value}"
        conditions.append(f"{lower} AND {below}" if lower else f"({below} OR {column} IS NULL)")
        if times[cut] > 1:
            conditions.append(f"{column} = {value}")
        lower = f"{column} > {value}" if times[cut] > 1 else f"{column} >= {value}"
    return [*conditions, lower] if lower else [f"({column} IS NULL OR {column} IS NOT NULL)"]


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    split: Split | None = None,
    predicates: list[str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table or a query; filters and column choices made on the result are pushed down.

    ``predicates`` are disjoint conditions that together cover the table, one partition each.
    """
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    if split and predicates:
        raise ValueError("give either split or predicates")
    source = table if table is not None else f"({query}) AS t"
    # A wall-clock column keeps its value whatever the session's time zone.
    settings = {"preferTimestampNTZ": "true", "fetchsize": str(fetch_size), **options}
    if predicates:
        url = settings.pop("url")
        return spark.read.jdbc(url, source, predicates=predicates, properties=settings)
    reader = spark.read.format("jdbc").options(**settings).option("dbtable", source)
    if split:
        reader = reader.options(**split.options())
    return reader.load()


def read_tables(
    spark: SparkSession, options: Mapping[str, str], tables: list[str]
) -> dict[str, DataFrame]:
    """Several whole tables by name."""
    return {name: read_jdbc(spark, options, table=name) for name in tables}
