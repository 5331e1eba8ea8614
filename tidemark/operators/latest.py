"""Latest-row-per-key operators.

A key may hold a large share of all rows. Each operator therefore reduces a key's rows
inside the map tasks first, so that one task hands on at most a few rows per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import row_hash, tie_break


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` for every key.

    ``max_by`` combines on the map side and leaves the result partitioned by the keys,
    which a following merge or join on them reuses.
    """
    payload = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*payload), tie_break(df, order_cols)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


def newest_versions(
    df: DataFrame, keys: list[str], order_cols: list[str], n: int = 1, rank_col: str = "rn"
) -> DataFrame:
    """The ``n`` newest rows of every key, numbered from 1.

    Spark turns the bound on ``row_number`` into a group limit on both sides of the
    shuffle, so a hot key sends at most ``n`` rows per map task.
    """
    order = [F.col(c).desc() for c in order_cols] + [row_hash(df).desc()]
    ranked = df.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank_col) <= n)


def live_rows(
    df: DataFrame, keys: list[str], order_cols: list[str], deleted: Column
) -> DataFrame:
    """Latest row per key without the keys whose latest row carries the delete flag."""
    return latest_per_key(df, keys, order_cols).filter(~F.coalesce(deleted, F.lit(False)))
