"""Full refresh of file tables without overwriting what a reader may be using.

Each refresh writes its own folder and then appends one row to a release log; readers
follow the newest row. Tables published together therefore change together. A job that
fails before the row is appended leaves readers on the old release, and its retry writes
the same folder again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from tidemark.sinks.files import write_files
from tidemark.sources.files import read_files, read_or_empty

RELEASE_SCHEMA = StructType(
    [
        StructField("release", StringType(), False),
        StructField("released_at", TimestampNTZType(), False),
        StructField("number", LongType(), False),
    ]
)


def released(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/releases", RELEASE_SCHEMA)


def latest_release(spark: SparkSession, root: str) -> str | None:
    return newest_release(spark, root)[0]


def newest_release(spark: SparkSession, root: str) -> tuple[str | None, datetime | None, int]:
    """Name, time and number of the newest release; releases count from 0."""
    newest = F.max_by(F.struct("release", "released_at", "number"), "number").alias("newest")
    row = released(spark, root).agg(newest).first()["newest"]
    return (row["release"], row["released_at"], row["number"]) if row else (None, None, -1)


def announce(spark: SparkSession, root: str, release: str, at: datetime) -> None:
    """Make a release that is completely written the current one.

    Releases are ordered by their number. A release dated before the newest one is refused:
    it would be built on a later state than it claims.
    """
    _, newest, number = newest_release(spark, root)
    if newest is not None and at < newest:
        raise ValueError(f"release {release!r} of {root} is dated before the newest one")
    write_files(spark.createDataFrame([(release, at, number + 1)], RELEASE_SCHEMA), f"{root}/releases")


def refuse_published(spark: SparkSession, root: str, release: str) -> None:
    """A published release may be in use, so its folder must not be written again."""
    if not released(spark, root).filter(F.col("release") == release).isEmpty():
        raise ValueError(f"release {release!r} of {root} is already published")


def _folder(root: str, release: str, table: str) -> str:
    return f"{root}/data/release={release}/{table}"


def publish(
    tables: Mapping[str, DataFrame],
    root: str,
    release: str,
    at: datetime,
    check: Callable[[dict[str, DataFrame]], None] | None = None,
) -> None:
    """Write the tables as one release and make it the current one.

    ``check`` gets the written tables; if it raises, readers stay on the old release.

    The writes are independent jobs and are submitted together, so that small tables
    fill the cluster's gaps beside a large one.
    """
    spark = next(iter(tables.values())).sparkSession
    refuse_published(spark, root, release)

    def write(name: str) -> None:
        write_files(tables[name], _folder(root, release, name), mode="overwrite")

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), tables))
    if check:
        check({name: read_files(spark, _folder(root, release, name)) for name in tables})
    announce(spark, root, release, at)


def read_current(spark: SparkSession, root: str, *tables: str) -> list[DataFrame]:
    """The named tables, all of the newest release."""
    release = latest_release(spark, root)
    if release is None:
        raise LookupError(f"{root} has no release")
    return [read_files(spark, _folder(root, release, name)) for name in tables]
