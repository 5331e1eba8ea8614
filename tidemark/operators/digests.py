"""Find rows that differ between a source and its copy without moving the rows.

Each side is summed up per range of key hashes: a count and sums of row hashes, which do not
depend on the order of rows. Only rows in ranges whose sums differ are compared. Descending
goes from a few wide ranges to narrow ones: each level sums up the ranges that differed on the
level above, so it reads both sides once but sums, and returns, what lies in those ranges only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import comparable

FANOUT_BITS = 5
LEVELS = 3


def _range(keys: list[str], level: int) -> Column:
    """Number of the key's range on a level; each level cuts the ranges of the one above."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - FANOUT_BITS * level)


def digests(df: DataFrame, keys: list[str], level: int) -> DataFrame:
    """Count and sums of row hashes per range; combined in the map tasks."""
    rows = df.select(_range(keys, level).alias("range"), F.xxhash64(*[comparable(df, c) for c in sorted(df.columns)]).alias("h"))
    # Halves of the hashes keep the sums far from overflow.
    low, high = F.col("h").bitwiseAND(F.lit(2**32 - 1)), F.shiftrightunsigned("h", 32)
    return rows.groupBy("range").agg(F.count(F.lit(1)).alias("rows"), F.sum(low).alias("low"), F.sum(high).alias("high"))


def within(keys: list[str], level: int, ranges: list[int] | None) -> Column:
    """Whether a row lies in one of the ranges of a level; None stands for all."""
    return F.lit(True) if ranges is None else _range(keys, level).isin(ranges) if ranges else F.lit(False)


def differing_ranges(source: DataFrame, copy: DataFrame, keys: list[str], levels: int = LEVELS) -> list[int]:
    """Ranges of the finest level whose rows differ, found from level to level.

    A level sums at most ``2 ** FANOUT_BITS`` ranges for each that differed above it, and the
    descent ends early where nothing differs. The driver sees numbers of ranges only, at most
    ``2 ** (FANOUT_BITS * levels)``.
    """
    ranges: list[int] | None = None
    for level in range(1, levels + 1):
        sides = [
            digests(df.filter(within(keys, level - 1, ranges)), keys, level).select("range", F.struct("rows", "low", "high").alias(name))
            for name, df in (("a", source), ("b", copy))
        ]
        apart = sides[0].join(sides[1], "range", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
        ranges = sorted(r["range"] for r in apart.select("range").collect())
        if not ranges:
            break
    return ranges or []


def unstamped_changes(source: DataFrame, copy: DataFrame, keys: list[str], stamp: str, levels: int = LEVELS) -> DataFrame:
    """Keys whose row changed without a newer change time, or that are gone from the source.

    Both sides hold one row per key. ``finding`` is ``unstamped`` (the row differs, its stamp
    is not newer), ``unloaded`` (a newer stamp, or a key that was never loaded) or ``gone``.
    """
    ranges = differing_ranges(source, copy, keys, levels)
    inside = within(keys, levels, ranges)
    columns = sorted(source.columns)
    left, right = (
        df.filter(inside).select(*[F.col(k).alias(f"_{side}_{k}") for k in keys], F.col(stamp).alias(f"{side}_stamp"),
                                 F.struct(*[comparable(df, c).alias(c) for c in columns]).alias(side))
        for side, df in (("source", source), ("copy", copy))
    )
    same = [F.col(f"_source_{k}").eqNullSafe(F.col(f"_copy_{k}")) for k in keys]
    met = left.join(right, same, "full_outer").filter(~F.col("source").eqNullSafe(F.col("copy")))
    finding = (
        F.when(F.col("source").isNull(), "gone")
        .when(F.col("copy").isNull() | (F.col("source_stamp") > F.col("copy_stamp")), "unloaded")
        .otherwise("unstamped")
    )
    return met.select(*[F.coalesce(f"_source_{k}", f"_copy_{k}").alias(k) for k in keys], finding.alias("finding"))
