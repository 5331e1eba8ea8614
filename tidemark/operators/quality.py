"""Data-quality checks: each one is a small report over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.union import stack


def duplicate_grain(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def uniqueness(checks: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per named check: how many key values repeat and how many rows are surplus."""
    return stack(
        *[
            duplicate_grain(df, keys).agg(
                F.lit(name).alias("check_name"),
                F.count("*").alias("repeated_keys"),
                F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus_rows"),
            )
            for name, (df, keys) in checks.items()
        ]
    ).select("check_name", "repeated_keys", "surplus_rows")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows that hold them.

    Both sides are reduced to one row per value before they meet, so a hot value costs
    nothing extra, also where the parent repeats its key. A NULL foreign key refers to
    nothing and is not an orphan.
    """
    held = child.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("row_count"))
    return held.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def referential_integrity(
    checks: dict[str, tuple[DataFrame, DataFrame, str, str]],
) -> DataFrame:
    """Per named check: number of orphan values and of child rows that hold them."""
    return stack(
        *[
            orphans(child, parent, fk, pk).agg(
                F.lit(name).alias("check_name"),
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
            )
            for name, (child, parent, fk, pk) in checks.items()
        ]
    ).select("check_name", "orphan_keys", "orphan_rows")


def references_between(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str, left_check: str | None, right_check: str | None
) -> DataFrame:
    """Orphans of both sides of a reference from one join; a check without name is left out.

    Each table is read once and reduced to one count per value before the sides meet.
    """
    held = left.filter(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("l")).agg(F.count("*").alias("l_rows"))
    known = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("r")).agg(F.count("*").alias("r_rows"))
    met = held.join(known, held.l == known.r, "full")

    def found(name: str, key: str, other: str, rows: str) -> Column:
        orphan = F.col(key).isNotNull() & F.col(other).isNull()
        return F.struct(
            F.lit(name).alias("check_name"),
            F.count_if(orphan).alias("orphan_keys"),
            F.coalesce(F.sum(F.when(orphan, F.col(rows))), F.lit(0)).alias("orphan_rows"),
        )

    checks = [found(left_check, "l", "r", "l_rows")] if left_check else []
    checks += [found(right_check, "r", "l", "r_rows")] if right_check else []
    return met.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: number of NULLs. All columns share one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Per named frame: number of rows."""
    return stack(
        *[
            df.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in frames.items()
        ]
    )


def lines_per_order(fact: DataFrame) -> DataFrame:
    """Number of fact rows per order."""
    return fact.groupBy("order_id").agg(F.count("*").alias("line_count"))
