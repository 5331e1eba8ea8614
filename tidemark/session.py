"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# With more than 2000 shuffle partitions Spark averages block sizes, which hides a hot
# partition from the adaptive skew join; the factor keeps the sizes of outliers exact.
# The hash join threshold lets adaptive execution skip the sort of a join whose build side
# is known to fit partition by partition; it must not be below the advisory size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.shuffle.accurateBlockSkewedFactor": "5.0",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; keyword settings (dots written as ``__``) win over ``DEFAULTS``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


MIB = 1024**2


def settings_for(shuffled_bytes: int, per_partition: int = 128 * MIB) -> dict[str, str]:
    """Settings for jobs that shuffle about ``shuffled_bytes``.

    The partition count is an upper bound: adaptive execution merges partitions that turn
    out small, but it never adds any, so the count must suit the largest shuffle. Larger
    scan splits go with it; they keep the number of map tasks down and give partial
    aggregation more rows to combine.
    """
    count = max(200, -(-shuffled_bytes // per_partition))
    return {
        "spark.sql.shuffle.partitions": str(count),
        "spark.sql.files.maxPartitionBytes": str(2 * per_partition),
    }


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for tables that Spark writes and reads back.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    temporary folder, which goes when the process ends: there, driver and executors share
    one disk. Tables are the caller's to remove.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the scratch area and read it back.

    The result no longer depends on the frame's sources, survives the loss of executors,
    and is computed once however often it is used.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch area; no two calls return the same one."""
    return f"{scratch_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
