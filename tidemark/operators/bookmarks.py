"""Bookmarks: the last change time that was loaded from each source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from tidemark.functions import instant
from tidemark.operators.latest import latest_per_key
from tidemark.operators.union import stack

BOOKMARK_SCHEMA = StructType(
    [
        StructField("table_name", StringType(), False),
        StructField("last_value", TimestampNTZType(), True),
        StructField("updated_at", TimestampNTZType(), True),
    ]
)

EPOCH = datetime(1970, 1, 1)


def empty_bookmarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BOOKMARK_SCHEMA)


def bookmark_row(spark: SparkSession, source: str, value: datetime, as_of: datetime) -> DataFrame:
    return spark.createDataFrame([(source, value, as_of)], BOOKMARK_SCHEMA)


def seed_bookmarks(
    bookmarks: DataFrame, sources: DataFrame, as_of: datetime, start: datetime = EPOCH
) -> DataFrame:
    """Add a bookmark at ``start`` for each ``table_name`` in ``sources`` that has none."""
    seeds = sources.select(
        "table_name", instant(start).alias("last_value"), instant(as_of).alias("updated_at")
    )
    ranked = stack(
        bookmarks.withColumn("_known", F.lit(1)), seeds.withColumn("_known", F.lit(0))
    )
    return latest_per_key(ranked, ["table_name"], ["_known"]).drop("_known")


def bookmark_of(bookmarks: DataFrame, source: str) -> DataFrame:
    """The bookmark row of one source; no row when it was never loaded."""
    return bookmarks.filter(F.col("table_name") == source)


def get_bookmark(bookmarks: DataFrame, source: str) -> datetime | None:
    """The bookmark of one source, or None when it was never loaded. Runs a one-row job."""
    row = bookmark_of(bookmarks, source).agg(F.max("last_value")).first()
    return row[0]


def upsert_bookmark(
    bookmarks: DataFrame, source: str, value: datetime, as_of: datetime
) -> DataFrame:
    """Bookmarks with the one of ``source`` replaced; all others stay as they are.

    The caller must not write the result over the table ``bookmarks`` is read from.
    The jobs in this package append to a log instead (see ``current_bookmarks``).
    """
    others = bookmarks.filter(F.col("table_name") != source)
    return others.unionByName(bookmark_row(bookmarks.sparkSession, source, value, as_of))


def current_bookmarks(log: DataFrame) -> DataFrame:
    """The newest entry of each source in an append-only bookmark log."""
    return latest_per_key(log, ["table_name"], ["last_value", "updated_at"])
