"""Stored dimensions of types 1, 2 and 3 that are refreshed batch by batch.

A dimension is ordinary Parquet, partitioned by a bucket of its key and, within the bucket,
by part. The part ``current`` holds one row per key; rows of a type-2 history lie in the part
of the release that closed them. A refresh reads and replaces the current parts of the
buckets that its batch has keys of, and adds a part with the versions it closes. The history
is neither read nor listed, unless a row comes late.

A type-2 row is late if its key has a stored row at or after it. Then the key's whole history
is put in order again: the version whose interval holds the late row is split, equal
neighbours become one, later versions are renumbered, and the parts that hold rows of such
keys are written again. To be able to do so, the dimension also keeps the rows that changed
nothing when they came; readers do not see them. Batches in any order give the history that
all rows together give.

The first load is a refresh of an empty dimension. Rows without a key, and for type 2 without
a change time, are refused before anything is written, as are columns that the dimension lacks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.operators.latest import latest_per_key
from tidemark.operators.scd1 import scd1_merge
from tidemark.operators.scd2 import OPENS, REACHED, Scd2
from tidemark.operators.scd3 import scd3_initial, scd3_merge
from tidemark.operators.union import stack
from tidemark.sinks.files import remove_folder, write_files
from tidemark.sinks.overwrite import data_path, folder_of, refuse_release, replace_partitions, roll_forward
from tidemark.sinks.releases import latest_release
from tidemark.sources.files import existing

BUCKET, PART, CURRENT = "dim_bucket", "dim_part", "current"
RESERVED = {BUCKET, PART, OPENS, REACHED}


@dataclass(frozen=True)
class Type1:
    """One row per key; the newest by ``order_cols``, or with ``incoming_wins`` the last batch's."""

    keys: list[str]
    order_cols: list[str]
    incoming_wins: bool = False

    def merged(self, stored: DataFrame | None, batch: DataFrame) -> DataFrame:
        if stored is None:
            return latest_per_key(batch, self.keys, self.order_cols)
        return scd1_merge(stored, batch, self.keys, self.order_cols, self.incoming_wins)

    def lacks(self, stored: DataFrame, batch: DataFrame) -> list[str]:
        return sorted(set(batch.columns) - set(stored.columns))


@dataclass(frozen=True)
class Type3:
    """One row per key with the current and the previous value of ``column``."""

    keys: list[str]
    column: str
    order_cols: list[str]
    mode: str = "patch"

    def merged(self, stored: DataFrame | None, batch: DataFrame) -> DataFrame:
        if stored is None:
            return scd3_initial(latest_per_key(batch, self.keys, self.order_cols), self.column)
        return scd3_merge(stored, batch, self.keys, self.column, self.order_cols, self.mode)

    def lacks(self, stored: DataFrame, batch: DataFrame) -> list[str]:
        return sorted(set(batch.columns) - set(stored.columns) - {self.column})


@dataclass(frozen=True)
class StoredDimension:
    """``buckets`` is fixed for the life of the table; size it so that one fits a task."""

    root: str
    kind: Scd2 | Type1 | Type3
    buckets: int = 64

    def bucket_of(self, schema: StructType) -> Column:
        """Integers hash alike whatever their width, so a batch may bring a narrower key."""
        whole = ("byte", "short", "integer", "long")
        keys = [F.col(k).cast("long") if schema[k].dataType.typeName() in whole else F.col(k) for k in self.kind.keys]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")


@dataclass(frozen=True)
class Refreshed:
    buckets: list[int]  # whose current rows were replaced
    late_keys: int  # whose history was put in order again


def _read(spark: SparkSession, dim: StoredDimension, folders: list[str]) -> DataFrame | None:
    """Rows of the given folders, as far as they exist, with their bucket and part."""
    base = data_path(dim.root)
    paths = existing(spark, [f"{base}/{f}" if f else base for f in folders])
    if not paths:
        return None
    found = spark.read.option("basePath", base).parquet(*paths).schema
    kinds = {BUCKET: IntegerType(), PART: StringType()}
    schema = StructType([StructField(f.name, kinds.get(f.name, f.dataType), True) for f in found.fields])
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def _folder(bucket: int, part: str) -> str:
    return folder_of([BUCKET, PART], {BUCKET: bucket, PART: part})


def refresh_dimension(dim: StoredDimension, staging: DataFrame, release: str, at: datetime) -> Refreshed:
    """Merge a batch. A retry with the same ``release`` repeats a failed attempt.

    An empty batch changes nothing and leaves no release.
    """
    spark, kind, root = staging.sparkSession, dim.kind, dim.root
    if release == CURRENT:
        raise ValueError(f"a release may not be named {CURRENT!r}")
    if taken := sorted(RESERVED & set(staging.columns)):
        raise ValueError(f"the batch has columns of reserved names: {taken}")
    roll_forward(spark, root)
    refuse_release(spark, root, release, at)
    work = f"{root}/work/{release}-{uuid.uuid4().hex}"
    write_files(staging.withColumn(BUCKET, dim.bucket_of(staging.schema)), f"{work}/batch")
    schema = StructType([*staging.schema.fields, StructField(BUCKET, IntegerType(), True)])
    batch = spark.read.schema(schema).parquet(f"{work}/batch")
    known = batch.agg(
        F.count_if(F.greatest(*[F.col(k).isNull() for k in kind.keys], F.lit(False))).alias("no_key"),
        F.count_if(F.col(kind.ts_col).isNull() if isinstance(kind, Scd2) else F.lit(False)).alias("no_time"),
        F.array_sort(F.collect_set(BUCKET)).alias("buckets"),
    ).first()
    if known.no_key:
        raise ValueError(f"the batch holds {known.no_key} rows without a key")
    if known.no_time:
        raise ValueError(f"the batch holds {known.no_time} rows without {kind.ts_col}")
    late_keys = 0
    if known.buckets:
        current = _read(spark, dim, [_folder(b, CURRENT) for b in known.buckets])
        if isinstance(kind, Scd2):
            rows, concerned, late_keys = _versions(spark, dim, kind, current, batch, release, work)
        else:
            stored = current.drop(BUCKET, PART) if current is not None else None
            _refuse_new(kind.lacks(stored, batch.drop(BUCKET)) if stored is not None else [], root)
            merged = kind.merged(stored, batch.drop(BUCKET))
            rows = merged.withColumns({BUCKET: dim.bucket_of(merged.schema), PART: F.lit(CURRENT)})
            concerned = []
        replace_partitions(rows, root, release, at, [BUCKET, PART], concerned)
    remove_folder(spark, work)
    return Refreshed(list(known.buckets), late_keys)


def _refuse_new(columns: list[str], root: str) -> None:
    if columns:
        raise ValueError(f"the batch has columns that {root} lacks: {columns}")


def _versions(
    spark: SparkSession, dim: StoredDimension, scd: Scd2, current: DataFrame | None, batch: DataFrame, release: str, work: str
) -> tuple[DataFrame, list[str], int]:
    """What to store for a type-2 batch, the folders that may end up empty, and the late keys."""
    incoming = {"_stored": F.lit(False), "_base": F.lit(None).cast("long"), PART: F.lit(None).cast("string")}
    if current is None:
        own = [c for c in batch.columns if c != BUCKET]
        found = scd.spliced(batch.withColumns(incoming), own, work)
        return _parted(found, release), [], 0
    own = [c for c in current.columns if c not in {*scd.versioning(), *RESERVED}]
    _refuse_new(sorted(set(batch.columns) - set(own) - {BUCKET}), dim.root)
    batch = batch.select(*[F.col(c).cast(current.schema[c].dataType).alias(c) for c in [*own, BUCKET]])
    # The batch meets the current rows once; all steps below read the settled outcome.
    met = current.join(scd.first_rows(batch, own), scd.keys, "left").select(*current.columns, "_first")
    write_files(met, f"{work}/met")
    met = spark.read.schema(met.schema).parquet(f"{work}/met")
    touched = met.filter("_first IS NOT NULL")
    late = touched.filter(F.col("_first") <= F.col(REACHED)).select(*scd.keys, BUCKET)
    write_files(late, f"{work}/late")
    late = spark.read.schema(late.schema).parquet(f"{work}/late")
    # Late keys are settled, so that all steps below agree on them.
    found = late.agg(F.count("*").alias("keys"), F.collect_set(BUCKET).alias("buckets")).first()

    untouched = met.filter("_first IS NULL")
    columns = [*own, BUCKET, PART, "_stored", "_base"]
    last = touched.join(late, scd.keys, "left_anti") if found.keys else touched
    rows = [batch.withColumns(incoming), last.withColumns({"_stored": F.lit(True), "_base": scd.versions_before()})]
    kept, concerned = [untouched], []
    if found.keys:
        stored = {"_stored": F.lit(True), "_base": F.lit(None).cast("long")}
        rows.append(touched.join(late, scd.keys, "left_semi").withColumns(stored))
        history = _read(spark, dim, [f"{BUCKET}={b}" for b in sorted(found.buckets)]).filter(F.col(PART) != CURRENT)
        again = history.join(late, scd.keys, "left_semi")
        parts = again.select(BUCKET, PART).distinct().collect()  # folders: at most buckets times releases
        if parts:
            concerned = [folder_of([BUCKET, PART], p) for p in parts]
            rows.append(again.withColumns(stored))
            kept.append(_read(spark, dim, concerned).join(late, scd.keys, "left_anti"))
    made = _parted(scd.spliced(stack(*[r.select(*columns) for r in rows]), own, work), release)
    typed = made.select(*[F.col(c).cast(current.schema[c].dataType).alias(c) for c in current.columns])
    return stack(typed, *[k.select(*current.columns) for k in kept]), concerned, found.keys


def _parted(rows: DataFrame, release: str) -> DataFrame:
    """Current rows go to their part; others stay in theirs or go to that of the release."""
    was = F.when(F.col(PART) != CURRENT, F.col(PART))
    part = F.when(F.col(REACHED).isNotNull(), CURRENT).otherwise(F.coalesce(was, F.lit(release)))
    return rows.withColumn(PART, part)


def _shown(dim: StoredDimension, rows: DataFrame) -> DataFrame:
    rows = rows.filter(OPENS) if isinstance(dim.kind, Scd2) else rows
    return rows.drop(*RESERVED)


def _published(spark: SparkSession, dim: StoredDimension) -> None:
    if latest_release(spark, dim.root) is None:
        raise LookupError(f"{dim.root} has no release")


def current_rows(spark: SparkSession, dim: StoredDimension) -> DataFrame:
    """The current row of every key; the history is not read."""
    _published(spark, dim)
    return _shown(dim, _read(spark, dim, [""]).filter(F.col(PART) == CURRENT))


def read_dimension(spark: SparkSession, dim: StoredDimension) -> DataFrame:
    """Every version of every key."""
    _published(spark, dim)
    return _shown(dim, _read(spark, dim, [""]))
