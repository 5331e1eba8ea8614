"""Structured Streaming over landed change files.

Polling with a bookmark and a stream with ``availableNow`` do the same work: each run
takes what has arrived since the last one and stops. Here the stream's checkpoint is the
bookmark.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.plans.dimension_refresh import StoredDimension, refresh_dimension
from tidemark.sinks.overwrite import roll_forward
from tidemark.sinks.releases import released
from tidemark.sources.files import CSV, map_texts, plain_text

# The property in which Spark names the running stream; it is kept in the checkpoint.
STREAM_ID = "sql.streaming.queryId"


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """New files under ``path`` as a stream; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        return map_texts(reader.options(**CSV).option("mode", "FAILFAST").load(path), plain_text)
    return reader.load(path)


def run_available(
    stream: DataFrame, each_batch: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Hand everything that has arrived to ``each_batch``, then stop."""
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def keep_refreshed(dim: StoredDimension, at: datetime) -> Callable[[DataFrame, int], None]:
    """A batch handler that merges micro-batches into a stored dimension.

    The release is named after the stream and its batch number, so a batch that Spark repeats
    after a failure finds its release published and does nothing. A stream with a new
    checkpoint has a new id: its batches are merged, whatever their numbers are, and rows
    that were merged before change nothing.
    """
    seen = {"stream": "no-stream"}  # a call outside a stream repeats a batch of the last one

    def merge_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = seen["stream"] = spark.sparkContext.getLocalProperty(STREAM_ID) or seen["stream"]
        release = f"{stream}-{number:012d}"
        roll_forward(spark, dim.root)
        if released(spark, dim.root).filter(F.col("release") == release).isEmpty():
            refresh_dimension(dim, batch, release, at)

    return merge_batch
