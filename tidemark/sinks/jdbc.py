"""JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.session import settle


def write_jdbc(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    mode: str = "overwrite",
    truncate: bool = True,
    batch_size: int = 5_000,
    writers: int | None = None,
) -> None:
    """Write a table. ``truncate`` keeps the declared table with its keys and indexes.

    ``df`` must not read from ``table``: the overwrite empties it before the rows are
    read. Write such a frame to a file table first. ``writers`` bounds the number of
    connections.
    """
    writer = df.write.format("jdbc").options(**options).mode(mode)
    writer = writer.option("dbtable", table).option("batchsize", str(batch_size))
    writer = writer.option("truncate", str(truncate).lower())
    if writers:
        writer = writer.option("numPartitions", str(writers))
    writer.save()


def rewrite_jdbc(
    df: DataFrame, options: Mapping[str, str], table: str, **settings: object
) -> None:
    """Overwrite a table with rows that may be derived from it, such as a bookmark upsert.

    The rows are settled in the scratch area before the table is emptied.
    """
    write_jdbc(settle(df, table), options, table, mode="overwrite", **settings)


def write_tables(
    frames: Mapping[str, DataFrame], options: Mapping[str, str], **settings: object
) -> None:
    """Write several tables in the order given; put referenced tables first."""
    for table, df in frames.items():
        write_jdbc(df, options, table, **settings)
