"""Current state of a landed source, kept beside its batches.

The landing only grows. Its newest row per key is kept as a stored type-1 dimension up to
some batch; asking for the state reads the batches after that one, merges them into the
buckets of their keys, and returns the stored rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.plans.dimension_refresh import StoredDimension, Type1, current_rows, refresh_dimension
from tidemark.plans.incremental_job import Landing, read_batches
from tidemark.sinks.overwrite import roll_forward
from tidemark.sinks.releases import released


def _release(number: int) -> str:
    return f"upto-{number:012d}"


def current_state(
    spark: SparkSession,
    source: str,
    landing: Landing,
    source_schema: StructType,
    keys: list[str],
    order_cols: list[str],
    at: datetime,
    buckets: int = 64,
) -> DataFrame:
    """Newest row per key over all committed batches, of which each is read once.

    Rows that mark a deletion stay as the newest row of their key. A job that dies while it
    merges is finished, or repeated, by the next call.
    """
    state = StoredDimension(f"{landing.root}/state/{source}", Type1(keys, order_cols), buckets)
    roll_forward(spark, state.root)
    done = released(spark, state.root).agg(F.max("release").alias("release")).first().release
    merged = int(done.removeprefix("upto-")) if done else -1
    log = landing.log(spark).filter((F.col("table_name") == source) & (F.col("number") > merged))
    new = log.select("number", "batch_id").orderBy("number").collect()  # a row for each new batch
    if new:
        rows = read_batches(spark, source, landing, source_schema, [r.batch_id for r in new])
        refresh_dimension(state, rows.select(*source_schema.names), _release(new[-1].number), at)
    if not new and done is None:
        return spark.createDataFrame([], source_schema)
    return current_rows(spark, state).select(*source_schema.names)
