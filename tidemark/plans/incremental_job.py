"""Incremental load of one source into a landing folder.

Order of steps: fix the slice, land it, measure what landed, move the bookmark. The
source is read once. Size and new bookmark come from the landed files, so they describe
exactly what was written even if an executor was lost and a task read the source again.

A batch is named after its number among the source's committed batches and the bookmark
it starts from. If the job dies before the batch is committed, the next run writes the same
folder again; a committed folder is never written again, also where an overlap reads the
same rows once more. One job per source and landing folder may run at a time.

Rows without a change time belong to no slice. They are counted in the landed files and
fail the load before anything is committed, or go to a folder of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidemark.functions import comparable
from tidemark.operators.bookmarks import BOOKMARK_SCHEMA
from tidemark.operators.incremental import Mark, incremental_slice, mark as to_mark, with_ingest_metadata
from tidemark.operators.latest import latest_per_key
from tidemark.sinks.files import remove_folder, write_files
from tidemark.sources.files import folders, read_files, read_or_empty

# ``mark`` is the bookmark as text of the change column's type; ``last_value`` shows it for
# timestamps and dates.
LOG_SCHEMA = StructType(
    [
        *BOOKMARK_SCHEMA.fields,
        StructField("batch_id", StringType(), False),
        StructField("mark", StringType(), False),
        StructField("number", LongType(), False),
        # Smallest and greatest change time of the batch; NULL in logs of older versions.
        StructField("least", StringType(), True),
        StructField("greatest", StringType(), True),
    ]
)
METADATA = [
    StructField("ingested_at", TimestampNTZType(), True),
    StructField("ingest_date", DateType(), True),
]


@dataclass(frozen=True)
class LoadResult:
    source: str
    rows: int
    bookmark_before: Mark | None
    bookmark_after: Mark | None
    batch_path: str | None
    quarantined: int = 0


class MissingChangeTime(ValueError):
    """The slice holds rows without a change time, so no bookmark could cover them."""


@dataclass(frozen=True)
class Landing:
    """Where the batches and the bookmark log of a set of sources live."""

    root: str
    fmt: str = "parquet"

    def batches(self, source: str) -> str:
        return f"{self.root}/landed/{source}"

    @property
    def log_path(self) -> str:
        return f"{self.root}/bookmarks"

    def log(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.log_path, LOG_SCHEMA)

    def bookmarks(self, spark: SparkSession) -> DataFrame:
        """Newest bookmark of each source; ``mark`` reads it for change columns of any type."""
        newest = latest_per_key(self.log(spark), ["table_name"], ["number"])
        return newest.select(*BOOKMARK_SCHEMA.names, "mark")

    def quarantine(self, source: str) -> str:
        return f"{self.root}/quarantine/{source}"


def is_stamp(kind: DataType) -> bool:
    return isinstance(kind, (TimestampType, TimestampNTZType))


def parsed(mark: str, kind: DataType) -> Mark:
    if is_stamp(kind):
        return datetime.fromisoformat(mark)
    if isinstance(kind, DateType):
        return date.fromisoformat(mark)
    return int(mark) if "decimal" not in kind.typeName() else Decimal(mark)


def as_text(mark: Mark) -> str:
    return mark.isoformat() if isinstance(mark, date) else str(mark)


def batch_name(number: int, lo: Mark | None) -> str:
    start = "initial" if lo is None else f"after-{lo:%Y%m%dT%H%M%S%f}" if isinstance(lo, datetime) else f"after-{lo}"
    return f"{number:08d}-{start}"


def landed_schema(source_schema: StructType) -> StructType:
    fields = [StructField(f.name, f.dataType, True) for f in source_schema.fields]
    return StructType(fields + METADATA)


def run_incremental(
    spark: SparkSession,
    source: str,
    df: DataFrame,
    cdc_col: str,
    landing: Landing,
    as_of: datetime,
    hi: Mark | None = None,
    overlap: timedelta | int = timedelta(0),
    quarantine: bool = False,
) -> LoadResult:
    """Load what changed since the bookmark and up to ``hi``.

    Without ``hi``, a timestamp column is bounded by ``as_of``; dates and numbers, which the
    run's clock says nothing about, are not bounded. A batch that brings nothing new, that is
    no row or only rows of the overlap that are landed already, is not committed and leaves
    the bookmark where it was. Rows without a change time raise ``MissingChangeTime``, or
    with ``quarantine`` are read once more and written to a folder of their own, each once.
    """
    kind = df.schema[cdc_col].dataType
    last = landing.log(spark).filter(F.col("table_name") == source)
    last = last.agg(F.max_by("mark", "number").alias("mark"), F.coalesce(F.max("number"), F.lit(-1)).alias("number")).first()
    lo = parsed(last.mark, kind) if last.mark is not None else None
    hi = as_of if hi is None and is_stamp(kind) else hi
    name = batch_name(last.number + 1, lo)
    path = f"{landing.batches(source)}/batch_id={name}"
    changed = incremental_slice(df, cdc_col, lo, hi, overlap, with_missing=not quarantine)
    if quarantine:
        changed = changed.filter(F.col(cdc_col).isNotNull())
    write_files(with_ingest_metadata(changed, as_of), path, landing.fmt, mode="overwrite", partition_by=["ingest_date"])
    written = read_files(spark, path, landing.fmt, landed_schema(df.schema))
    least, reached = (f(cdc_col).cast("timestamp_ntz") if is_stamp(kind) else f(cdc_col) for f in (F.min, F.max))
    found = written.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(cdc_col).isNull()).alias("missing"),
        least.alias("least"),
        reached.alias("reached"),
    ).first()
    if found.missing:
        raise MissingChangeTime(f"{found.missing} rows of {source} have no {cdc_col}; nothing was committed")
    set_aside = _set_aside(df.filter(F.col(cdc_col).isNull()), landing, source, name) if quarantine else 0
    after = found.reached if lo is None or (found.rows and found.reached > lo) else lo
    if found.rows == 0 or (after == lo and not _brings_news(spark, source, written, landing, df.schema, cdc_col, found.least)):
        return LoadResult(source, 0, lo, lo, None, set_aside)
    stamp = after if is_stamp(kind) else datetime(after.year, after.month, after.day) if isinstance(after, date) else None
    entry = [(source, stamp, as_of, name, as_text(after), last.number + 1, as_text(found.least), as_text(found.reached))]
    write_files(spark.createDataFrame(entry, LOG_SCHEMA), landing.log_path)
    return LoadResult(source, found.rows, lo, after, path, set_aside)


def _set_aside(rows: DataFrame, landing: Landing, source: str, name: str) -> int:
    """Store the rows that no earlier run, or failed attempt at this one, has set aside."""
    spark, root = rows.sparkSession, landing.quarantine(source)
    earlier = folders(spark, root)
    path = f"{root}/batch_id={name}-{len(earlier):06d}"
    if earlier:
        known = reduce(DataFrame.unionByName, [read_files(spark, p, landing.fmt, rows.schema) for p in earlier])
        rows = unknown_rows(rows, known)
    write_files(rows, path, landing.fmt, mode="overwrite")
    found = read_files(spark, path, landing.fmt, rows.schema).count()
    if not found:
        remove_folder(spark, path)
    return found


def unknown_rows(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows that are not known in the same form; maps are compared by their entries."""
    names = rows.columns
    form = F.struct(*[comparable(rows, c).alias(c) for c in names])
    return rows.join(known.select(F.struct(*[comparable(known, c).alias(c) for c in names]).alias("__known")), form.eqNullSafe(F.col("__known")), "left_anti")


def batches_since(spark: SparkSession, source: str, landing: Landing, kind: DataType, start: Mark) -> list[str]:
    """Committed batches that may hold rows changed at ``start`` or later, by their zone maps."""
    mine = landing.log(spark).filter(F.col("table_name") == source)
    greatest = F.col("greatest").cast(kind)
    met = mine.filter(greatest.isNull() | (greatest >= to_mark(start, kind)))
    return sorted(r.batch_id for r in met.select("batch_id").distinct().collect())


def _brings_news(
    spark: SparkSession, source: str, written: DataFrame, landing: Landing, schema: StructType, cdc_col: str, start: Mark
) -> bool:
    """Whether an overlap holds a row that no committed batch has in the same form.

    Only batches that reach the overlap are listed and read, and of them only rows in it.
    """
    kind = schema[cdc_col].dataType
    since = batches_since(spark, source, landing, kind, start)
    names = [f.name for f in schema.fields]
    if not since:
        return not written.isEmpty()
    landed = read_batches(spark, source, landing, schema, since).filter(F.col(cdc_col) >= to_mark(start, kind))
    return not unknown_rows(written.select(*names), landed.select(*names)).isEmpty()


def read_batches(spark: SparkSession, source: str, landing: Landing, source_schema: StructType, batches: list[str]) -> DataFrame:
    """The given batches of a source, and no other folder."""
    paths = [f"{landing.batches(source)}/batch_id={b}" for b in batches]
    schema = landed_schema(source_schema)
    return read_files(spark, paths, landing.fmt, schema, landing.batches(source)).select(*schema.names)


def read_landed(
    spark: SparkSession, source: str, landing: Landing, source_schema: StructType
) -> DataFrame:
    """All committed batches of a source. A batch whose bookmark never moved is left out."""
    schema = landed_schema(source_schema).add("batch_id", StringType())
    done = landing.log(spark).filter(F.col("table_name") == source).select("batch_id")
    rows = read_files(spark, landing.batches(source), landing.fmt, schema)
    return rows.join(done, "batch_id", "left_semi").select(*landed_schema(source_schema).names)
