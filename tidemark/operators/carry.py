"""Values of earlier and later rows of a key, without one task seeing all of the key's rows.

Rows are range-partitioned by key and order (``laid_out``). A window within the partition
finds the neighbours there; what a row needs from other partitions comes from a summary with
one row per partition and key. A key with a third of all rows is therefore many tasks' work,
and no join on times or row numbers is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.sinks.files import write_files

PART = "__part"


def laid_out(df: DataFrame, by: list[str], order: list[str], path: str, partitions: int | None = None) -> DataFrame:
    """The rows in range partitions of key and order, stored under ``path``, with their partition.

    They are stored because a range partitioning may fall differently when it is computed again.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *by, *order).withColumn(PART, F.spark_partition_id())
    write_files(placed, path)
    return spark.read.schema(placed.schema).parquet(path)


def carry(
    rows: DataFrame,
    by: list[str],
    order: list[str],
    previous: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    last: Mapping[str, Column] | None = None,
    count: str | None = None,
) -> DataFrame:
    """Add columns from the key's other rows in the given order, which must be free of ties.

    ``rows`` are rows of ``laid_out``, or a selection of them. ``previous`` and ``following``
    give the value of the row before and after, NULL at the ends; ``last`` the last value that
    is not NULL up to and including the row itself; ``count`` the row's number from 1.
    """
    previous, following, last = previous or {}, following or {}, last or {}
    place = F.struct(*order)
    summary = {f"__p_{c}": F.max_by(F.struct(v.alias("v")), place) for c, v in previous.items()}
    summary |= {f"__f_{c}": F.min_by(F.struct(v.alias("v")), place) for c, v in following.items()}
    summary |= {f"__l_{c}": F.max_by(F.struct(v.alias("v")), F.when(v.isNotNull(), place)) for c, v in last.items()}
    summary["__rows"] = F.count(F.lit(1))
    found = rows.groupBy(PART, *by).agg(*[v.alias(c) for c, v in summary.items()])
    across = Window.partitionBy(*by).orderBy(PART)
    before, after = across.rowsBetween(Window.unboundedPreceding, -1), across.rowsBetween(1, Window.unboundedFollowing)
    reach = {"__p_": lambda c: F.last(c, True).over(before), "__l_": lambda c: F.last(c, True).over(before)}
    reach["__f_"] = lambda c: F.lead(c).over(across)
    reach["__ro"] = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    found = found.select(
        F.col(PART).alias("__of"), *[F.col(c).alias(f"__of_{c}") for c in by], *[reach[c[:4]](c).alias(c) for c in summary]
    )
    match = F.col(PART) == F.col("__of")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    joined = rows.join(found, match)
    within = Window.partitionBy(PART, *by).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {c: F.coalesce(F.lag(F.struct(v.alias("v"))).over(within), F.col(f"__p_{c}"))["v"] for c, v in previous.items()}
    added |= {c: F.coalesce(F.lead(F.struct(v.alias("v"))).over(within), F.col(f"__f_{c}"))["v"] for c, v in following.items()}
    added |= {c: F.coalesce(F.last(v, True).over(upto), F.col(f"__l_{c}")["v"]) for c, v in last.items()}
    if count:
        added[count] = (F.row_number().over(within) + F.col("__rows")).cast("long")
    return joined.select(*rows.columns, *[v.alias(c) for c, v in added.items()])
