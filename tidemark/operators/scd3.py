"""Type 3: one row per key with the current and the previous value of one column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import differs
from tidemark.operators.pairing import pair_by_key


def _names(col: str) -> tuple[str, str]:
    return f"{col}_current", f"{col}_previous"


def scd3_initial(staging: DataFrame, col: str) -> DataFrame:
    """First load: the column becomes its current value, the previous one is NULL."""
    current, previous = _names(col)
    others = [c for c in staging.columns if c != col]
    kind = staging.schema[col].dataType
    return staging.select(
        *others, F.col(col).alias(current), F.lit(None).cast(kind).alias(previous)
    )


def scd3_merge(
    dim: DataFrame,
    staging: DataFrame,
    keys: list[str],
    col: str,
    order_cols: list[str],
    mode: str = "patch",
) -> DataFrame:
    """Merge a batch with one shuffle; the previous value moves only on a change.

    ``patch`` lets an incoming NULL leave the stored value alone; ``replace`` takes the
    incoming row whole.
    """
    if mode not in ("patch", "replace"):
        raise ValueError("mode must be 'patch' or 'replace'")
    current, previous = _names(col)
    was, now = F.col("was"), F.col("now")

    def merged(stored: str, incoming: str) -> Column:
        if mode == "patch":
            return F.coalesce(now[incoming], was[stored])
        return F.when(now.isNotNull(), now[incoming]).otherwise(was[stored])

    value = merged(current, col)
    shifted = F.when(
        was.isNotNull() & now.isNotNull() & differs(value, was[current]), was[current]
    ).otherwise(was[previous])
    values = {k: F.col(k) for k in keys} | {current: value, previous: shifted}
    paired = pair_by_key(dim, staging, keys, order_cols)
    return paired.select(
        *[(values[c] if c in values else merged(c, c)).alias(c) for c in dim.columns]
    )
