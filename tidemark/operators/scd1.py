"""Type 1: one row per key, changed attributes overwrite the old ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import required
from tidemark.operators.latest import latest_per_key
from tidemark.operators.union import align, stack


def scd1_merge(
    dim: DataFrame,
    staging: DataFrame,
    keys: list[str],
    order_cols: list[str],
    incoming_wins: bool = False,
) -> DataFrame:
    """Merge a batch into a type-1 dimension with one shuffle.

    By default the newest row by ``order_cols`` wins, so a late older row changes
    nothing. With ``incoming_wins`` the batch always replaces the stored row, and
    ``order_cols`` only choose among repeated keys within the batch. A row without a key fails
    the job.
    """
    dim, batch = (df.withColumns({k: required(k) for k in keys}) for df in (dim, align(staging, dim)))
    if not incoming_wins:
        return latest_per_key(stack(dim, batch), keys, order_cols)
    ranked = stack(
        dim.withColumn("_incoming", F.lit(0)), batch.withColumn("_incoming", F.lit(1))
    )
    return latest_per_key(ranked, keys, ["_incoming", *order_cols]).drop("_incoming")
