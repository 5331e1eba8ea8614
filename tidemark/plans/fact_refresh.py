"""A stored sales fact that is kept up to date by months.

The fact is ordinary Parquet, partitioned by the month of the order. A change slice names
the orders that were added, changed or removed. The months that hold them now, and those that
hold them in the stored fact, are derived again from the normalized tables and replaced; all
other months keep their files. The result is that of a full build.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions import date_key
from tidemark.operators.facts import fact_sales
from tidemark.sinks.overwrite import data_path, folder_of, refuse_release, replace_partitions, roll_forward
from tidemark.sources.files import existing

MONTH = "order_month"


def month_of(key: Column) -> Column:
    """Year and month of a date key; 0 for orders without a date."""
    return F.coalesce(F.floor(key / 100), F.lit(0)).cast("int")


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    path = data_path(root)
    if not existing(spark, [path]):
        return None
    found = spark.read.parquet(path).schema
    fields = [StructField(f.name, IntegerType() if f.name == MONTH else f.dataType, True) for f in found.fields]
    return spark.read.schema(StructType(fields)).parquet(path)


def refresh_fact(
    items: DataFrame, orders: DataFrame, root: str, release: str, at: datetime, changed: DataFrame | None = None
) -> list[int]:
    """Bring the stored fact up to ``items`` and ``orders``; returns the months written.

    ``changed`` holds the ``order_id`` of every order that differs from the last refresh in its
    header or a line, removed ones included; without it all months are written. Of the stored
    fact only ids and months are read, to find where changed orders were before.
    """
    spark = orders.sparkSession
    roll_forward(spark, root)
    refuse_release(spark, root, release, at)
    stored = _stored(spark, root)
    dated = orders.withColumn(MONTH, month_of(date_key(F.to_date("order_ts"))))
    now, before = dated.select("order_id", MONTH), stored.select("order_id", MONTH) if stored is not None else None
    if changed is not None:
        ids = changed.select("order_id").distinct()
        now = now.join(ids, "order_id", "left_semi")
        before = before.join(ids, "order_id", "left_semi") if before is not None else None
    touched = now.select(MONTH) if before is None else now.select(MONTH).unionByName(before.select(MONTH))
    months = sorted(r[MONTH] for r in touched.distinct().collect())  # as many as there are months at most
    if not months:
        return []
    concerned = dated.filter(F.col(MONTH).isin(months)).drop(MONTH)
    rows = fact_sales(items, concerned).withColumn(MONTH, month_of(F.col("date_key")))
    replace_partitions(rows, root, release, at, [MONTH], [folder_of([MONTH], {MONTH: m}) for m in months])
    return months


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    """The stored fact; a filter on ``order_month`` reads the months asked for only."""
    stored = _stored(spark, root)
    if stored is None:
        raise LookupError(f"{root} has no fact")
    return stored
