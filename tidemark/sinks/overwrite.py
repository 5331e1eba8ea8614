"""Replace some partitions of a Parquet table, from a settled copy.

The new rows of all partitions concerned are first written to a folder of the release. A note
beside it makes that copy valid; it also names partitions that are left without rows. Spark's
dynamic partition overwrite then replaces the partitions that the copy holds, the release is
announced, and note and copy go. A job that dies before the note is written leaves the table
as it was; one that dies later is finished by the next job, since overwriting from the copy
once more gives the same rows. One job per table may run at a time, and a reader that
needs all partitions of one release reads while none runs.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sinks.files import PARQUET_CODEC, remove_folder, write_files, write_text
from tidemark.sinks.releases import announce, released
from tidemark.sources.files import folders, read_text

def data_path(root: str) -> str:
    return f"{root}/data"


def _settled(root: str, release: str) -> str:
    return f"{root}/settled/{release}"


def _note(root: str, release: str) -> str:
    return f"{root}/prepared/{release}.json"


def folder_of(by: list[str], values) -> str:
    return "/".join(f"{c}={values[c]}" for c in by)


def _apply(rows: DataFrame, root: str, release: str, at: datetime, by: list[str], emptied: list[str]) -> None:
    spark = rows.sparkSession
    # Rebalancing gives a partition about one file, or several where it is large.
    writer = rows.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(data_path(root), compression=PARQUET_CODEC)
    for folder in emptied:
        remove_folder(spark, f"{data_path(root)}/{folder}")
    announce(spark, root, release, at)
    remove_folder(spark, _note(root, release))
    remove_folder(spark, _settled(root, release))


def roll_forward(spark: SparkSession, root: str) -> None:
    """Finish a release that was prepared but not completed."""
    for path in folders(spark, f"{root}/prepared"):
        note = json.loads(read_text(spark, path))
        if released(spark, root).filter(F.col("release") == note["release"]).isEmpty():
            rows = spark.read.parquet(_settled(root, note["release"]))
            _apply(rows, root, note["release"], datetime.fromisoformat(note["at"]), note["by"], note["emptied"])


def refuse_release(spark: SparkSession, root: str, release: str, at: datetime) -> None:
    """A release may not be published twice, nor be dated before the newest one."""
    newest = F.max_by("released_at", "number").alias("newest")
    known = released(spark, root).agg(newest, F.count_if(F.col("release") == release).alias("published")).first()
    if known.published:
        raise ValueError(f"release {release!r} of {root} is already published")
    if known.newest is not None and at < known.newest:
        raise ValueError(f"release {release!r} of {root} is dated before the newest one")


def replace_partitions(
    rows: DataFrame, root: str, release: str, at: datetime, by: list[str], concerned: list[str] = ()
) -> None:
    """Make ``rows`` the whole content of the partitions that they lie in.

    Call ``roll_forward`` and ``refuse_release`` first, before ``rows`` are made.
    ``concerned`` names partitions, as folders, that are removed where no row is left for them.
    """
    spark = rows.sparkSession
    write_files(rows, _settled(root, release), mode="overwrite")
    settled = spark.read.schema(rows.schema).parquet(_settled(root, release))
    emptied = set(concerned)
    if emptied:
        emptied -= {folder_of(by, r) for r in settled.select(*by).distinct().collect()}
    note = {"release": release, "at": at.isoformat(), "by": list(by), "emptied": sorted(emptied)}
    write_text(spark, _note(root, release), json.dumps(note))
    _apply(settled, root, release, at, list(by), sorted(emptied))
