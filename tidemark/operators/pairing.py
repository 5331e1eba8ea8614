"""Pair each key's stored row with its incoming row.

The usual form of a merge is a full outer join after removing repeated keys from the
batch: two or three shuffles, and an outer join on a hot key cannot be split. Here both
sides are stacked and grouped once. The grouping keeps one stored and one incoming row
per key already inside the map tasks, so one shuffle does the deduplication and the
match, and no key can grow beyond one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import required, tie_break


def _non_keys(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def pair_by_key(
    stored: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    order_cols: list[str],
    stored_when: Column | None = None,
    counter: str | None = None,
) -> DataFrame:
    """One row per key: ``was`` (stored row or NULL) and ``now`` (newest incoming or NULL).

    ``stored_when`` limits which stored rows count as the key's row. ``counter`` names a
    stored integer column whose greatest value over all stored rows becomes ``counted``.
    Two stored rows for one key break the dimension's contract and fail the job, rather
    than losing one of them; so does a row without a key.
    """
    row = F.struct(*_non_keys(stored, keys))
    left = stored.select(
        *[required(k) for k in keys],
        (F.when(stored_when, row) if stored_when is not None else row).alias("was"),
        (F.col(counter).cast("long") if counter else F.lit(None).cast("long")).alias("counted"),
    )
    right = incoming.select(
        *[required(k, stored.schema[k].dataType) for k in keys],
        F.struct(*_non_keys(incoming, keys)).alias("now"),
        tie_break(incoming, order_cols).alias("rank"),
    )
    both = left.unionByName(right, allowMissingColumns=True)
    key_text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    return (
        both.groupBy(*keys)
        .agg(
            F.first("was", ignorenulls=True).alias("was"),
            F.count("was").alias("stored_rows"),
            F.max("counted").alias("counted"),
            F.max_by("now", "rank").alias("now"),
        )
        .withColumn(
            "was",
            F.when(F.col("stored_rows") <= 1, F.col("was")).otherwise(
                F.raise_error(F.concat(F.lit("more than one stored row for key "), key_text))
            ),
        )
        .drop("stored_rows")
    )
