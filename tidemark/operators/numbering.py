"""Numbering of all rows in order, without one task seeing them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PART = "__part"


def number_rows(
    df: DataFrame,
    order: list[str | Column],
    name: str,
    path: str,
    by: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: 1, 2, 3 … in the given order, over all rows or within each key of ``by``.

    The rows are range-partitioned by key and order and numbered within their partition;
    the counts of earlier partitions are then added. A key with a third of all rows spreads
    over many tasks as long as its order columns differ. Ties of all order columns are
    numbered in no particular order, so give an order that ends in a unique column.

    ``path`` takes the partitioned rows, because a range partitioning may fall differently
    when it is computed again.
    """
    by = by or []
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in [*by, *order]]
    df.repartitionByRange(n, *keys).withColumn(PART, F.spark_partition_id()).write.parquet(path)
    rows = spark.read.schema(df.withColumn(PART, F.lit(0)).schema).parquet(path)
    counts = rows.groupBy(PART, *by).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition and key that lies in it; a key's rows are its partitions only.
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(PART).alias("__of"),
        *[F.col(c).alias(f"__of_{c}") for c in by],
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    match = F.col(PART) == F.col("__of")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    joined = rows.join(offsets, match)
    within = Window.partitionBy(PART, *by).orderBy(*order)
    return joined.select(*df.columns, (F.row_number().over(within) + F.col("__before")).cast("long").alias(name))
