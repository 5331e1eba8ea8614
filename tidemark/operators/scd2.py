"""Type 2: every version of a row is kept, with a half-open validity interval.

There are two ways to merge a batch. ``changes`` and what builds on it take the newest row
of each key and are one shuffle without writes; they suit batches with one change per key.
``spliced`` makes a version of each change, wherever in a key's history its time falls: it
orders stored and incoming rows together, drops what repeats its predecessor, numbers the
versions anew and closes each where the next one starts. Stored dimensions are refreshed so.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DataType

from tidemark.functions import any_differs, instant, required, surrogate_key
from tidemark.operators.carry import carry, laid_out
from tidemark.operators.pairing import pair_by_key
from tidemark.operators.union import stack
from tidemark.sinks.files import write_files

OPEN_END = datetime(9999, 12, 31)


# Columns that a stored dimension has besides its own: whether a row opens a version or repeats
# its predecessor, and on a current row the position of the key's last row.
OPENS = "_opens"
REACHED = "_reached"


@dataclass(frozen=True)
class Scd2:
    """How a type-2 dimension is keyed, compared and stored.

    ``tracked`` columns open a new version when they change; the others keep the values
    of the version they were stored with. ``open_end=None`` stores NULL as the end of the
    current version. ``version=None`` leaves out the version number. ``version_key`` names
    an optional surrogate key of the version, hashed from the key and the version's start.
    ``expire_at`` closes old versions at that time instead of the incoming change time.
    ``skip_late`` ignores an incoming row that is not newer than the stored version, which
    would otherwise make the two intervals overlap.
    """

    keys: list[str]
    tracked: list[str]
    ts_col: str
    order_cols: list[str] = field(default_factory=list)
    valid_from: str = "effective_from"
    valid_to: str = "effective_to"
    current: str = "is_current"
    version: str | None = "version"
    version_key: str | None = None
    current_type: DataType = BooleanType()
    open_end: datetime | None = OPEN_END
    expire_at: datetime | None = None
    skip_late: bool = True

    def _opening(self, start: Column, number: Column, stamp: DataType) -> dict[str, Column]:
        """The versioning columns of a row that becomes current at ``start``."""
        end = F.lit(None).cast(stamp) if self.open_end is None else instant(self.open_end, stamp)
        columns = {
            self.valid_from: start,
            self.valid_to: end,
            self.current: F.lit(True).cast(self.current_type),
        }
        if self.version:
            columns[self.version] = number.cast("int")
        if self.version_key:
            parts = [F.col(k).cast("string") for k in self.keys] + [start.cast("string")]
            columns[self.version_key] = surrogate_key(F.concat_ws("|", *parts))
        return columns

    def is_current(self) -> Column:
        return F.col(self.current).cast("boolean")

    def initial(self, staging: DataFrame) -> DataFrame:
        """First load: every row becomes current version 1."""
        stamp = staging.schema[self.ts_col].dataType
        return staging.withColumns(self._opening(F.col(self.ts_col), F.lit(1), stamp))

    def changes(self, dim: DataFrame, staging: DataFrame) -> DataFrame:
        """One row per key with its stored row, its newest incoming row and a verdict.

        ``change`` is ``new``, ``changed``, ``unchanged``, ``late`` or ``absent`` (no
        incoming row). ``counted`` is the greatest version ever given to the key, closed
        versions included, so that a returning key continues its numbering.
        """
        stored = dim if self.version else dim.filter(self.is_current())
        paired = pair_by_key(
            stored,
            staging,
            self.keys,
            self.order_cols or [self.ts_col],
            stored_when=self.is_current(),
            counter=self.version,
        )
        was, now = F.col("was"), F.col("now")
        moved = any_differs((was[c], now[c]) for c in self.tracked)
        stale = now[self.ts_col] <= was[self.valid_from]
        verdict = F.when(now.isNull(), "absent").when(was.isNull(), "new")
        if self.skip_late:
            verdict = verdict.when(moved & stale, "late")
        verdict = verdict.when(moved, "changed").otherwise("unchanged")
        return paired.withColumn("change", verdict)

    def changed_keys(self, changes: DataFrame) -> DataFrame:
        return changes.filter(F.col("change") == "changed").select(*self.keys)

    def _stored(self, dim: DataFrame, closing: Column) -> Column:
        """The stored row, closed where ``closing`` holds."""
        end = dim.schema[self.valid_to].dataType
        closed_at = (
            instant(self.expire_at, end) if self.expire_at else F.col("now")[self.ts_col].cast(end)
        )
        replaced = {
            self.valid_to: closed_at,
            self.current: F.lit(False).cast(dim.schema[self.current].dataType),
        }
        was = F.col("was")
        return F.struct(
            *[
                (F.when(closing, replaced[c]).otherwise(was[c]) if c in replaced else was[c]).alias(c)
                for c in dim.columns
                if c not in self.keys
            ]
        )

    def _opened(self, dim: DataFrame) -> Column:
        """The row that the incoming values open as the current version."""
        now = F.col("now")
        start = now[self.ts_col]
        number = F.coalesce(F.col("counted"), F.lit(0)) + 1
        opening = self._opening(start, number, dim.schema[self.valid_to].dataType)
        return F.struct(
            *[
                (opening[c] if c in opening else now[c]).cast(dim.schema[c].dataType).alias(c)
                for c in dim.columns
                if c not in self.keys
            ]
        )

    def _rows(self, dim: DataFrame, picked: DataFrame, row: Column) -> DataFrame:
        return picked.select(*self.keys, row.alias("r")).select(*self.keys, "r.*").select(*dim.columns)

    def expired(self, dim: DataFrame, changes: DataFrame) -> DataFrame:
        """The stored rows that the batch closes."""
        picked = changes.filter(F.col("change") == "changed")
        return self._rows(dim, picked, self._stored(dim, F.lit(True)))

    def opened(self, dim: DataFrame, changes: DataFrame, kinds: list[str]) -> DataFrame:
        """The rows that the batch opens for keys of the given kinds of change."""
        return self._rows(dim, changes.filter(F.col("change").isin(kinds)), self._opened(dim))

    def new_versions(self, dim: DataFrame, changes: DataFrame) -> DataFrame:
        return self.opened(dim, changes, ["changed"])

    def new_keys(self, dim: DataFrame, changes: DataFrame) -> DataFrame:
        return self.opened(dim, changes, ["new"])

    def rebuilt(self, dim: DataFrame, changes: DataFrame) -> DataFrame:
        """All rows of the dimension except the versions that were closed before."""
        closing = F.col("change") == "changed"
        opening = F.col("change").isin("changed", "new")
        kept = F.when(F.col("was").isNotNull(), self._stored(dim, closing))
        added = F.when(opening, self._opened(dim))
        rows = F.explode(F.array_compact(F.array(kept, added))).alias("r")
        return changes.select(*self.keys, rows).select(*self.keys, "r.*").select(*dim.columns)

    def merge(self, dim: DataFrame, staging: DataFrame) -> DataFrame:
        """The whole dimension after the batch. Closed versions pass through unshuffled."""
        history = dim.filter(~self.is_current())
        return stack(history, self.rebuilt(dim, self.changes(dim, staging)))

    def versioning(self) -> list[str]:
        """The columns that the dimension adds to the incoming ones."""
        return [c for c in (self.valid_from, self.valid_to, self.current, self.version, self.version_key) if c]

    def order(self) -> list[str]:
        """Columns in whose order the rows of a key follow each other."""
        return [self.ts_col, *[c for c in self.order_cols if c != self.ts_col]]

    def position(self, df: DataFrame, own: list[str] | None = None) -> Column:
        """Place of a row among its key's rows; ties of all order columns go by the row's hash."""
        own = own or [c for c in df.columns if c not in self.versioning()]
        hashed = F.xxhash64(*[c for c in sorted(own) if "map<" not in df.schema[c].dataType.simpleString()])
        return F.struct(*self.order(), hashed.alias("hash"))

    def first_rows(self, batch: DataFrame, own: list[str] | None = None) -> DataFrame:
        """Keys of the batch with the position of their first row, reduced in the map tasks."""
        return batch.groupBy(*self.keys).agg(F.min(self.position(batch, own)).alias("_first"))

    def spliced(self, rows: DataFrame, own: list[str], work: str) -> DataFrame:
        """The histories of all keys in ``rows``, over stored tables below the folder ``work``.

        ``rows`` are stored and incoming rows alike: the incoming columns ``own``, ``_stored``
        (false for incoming ones) and ``_base``, the number of versions that the key had
        before the rows at hand (null: 0). Other columns are carried. A row equal to its
        predecessor in all tracked columns opens nothing and is kept as a repeat, since a late
        row before it may part the two; a row that is there twice is kept once.

        Rows lie in range partitions of key and position, so a key with a third of them is
        many tasks' work, and take from their neighbours what they need.
        """
        if self.expire_at:
            raise ValueError("spliced versions end where the next one starts")
        spark, keys = rows.sparkSession, self.keys
        stamp = rows.schema[self.ts_col].dataType
        incoming = F.when(F.col("_stored"), 0).otherwise(1)
        rows = rows.withColumns({"_at": self.position(rows, own), "_in": incoming, "_row": F.monotonically_increasing_id()})
        order = ["_at", "_in", "_row"]
        placed = laid_out(rows, keys, order, f"{work}/placed")
        met = carry(placed, keys, order, previous={"_before": F.struct("_at", *self.tracked)})
        first = F.col("_before").isNull()
        moved = any_differs((F.col("_before")[c], F.col(c)) for c in self.tracked)
        twice = ~first & ~moved & F.col("_at").eqNullSafe(F.col("_before")["_at"])
        judged = met.filter(~twice).select(*placed.columns, (first | moved).alias(OPENS))
        write_files(judged, f"{work}/judged")
        judged = spark.read.schema(judged.schema).parquet(f"{work}/judged")

        opening = carry(
            judged.filter(OPENS), keys, order, following={"_ends": F.col(self.ts_col)}, last={"_before_all": F.col("_base")}, count="_n"
        )
        number = F.coalesce("_before_all", F.lit(0)) + F.col("_n")
        columns = self._opening(F.col(self.ts_col), number, stamp)
        closed = F.col("_ends").isNotNull()
        columns[self.valid_to] = F.when(closed, F.col("_ends")).otherwise(columns[self.valid_to])
        columns[self.current] = (~closed).cast(self.current_type)
        kept = [c for c in rows.columns if c not in (*order, "_stored", "_base")]
        opened = opening.withColumns(columns)
        # The current row of a key meets the position of the key's last row.
        lasts = judged.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max("_at").alias(REACHED))
        mine = [F.col(k) == F.col(f"_k_{k}") for k in keys]
        shown = [*kept, *self.versioning(), OPENS, REACHED]
        opened = opened.join(lasts, [*mine, F.col("_ends").isNull()], "left").select(*shown)
        repeats = judged.filter(~F.col(OPENS)).withColumns(
            {
                **{c: F.lit(None).cast(opened.schema[c].dataType) for c in (*self.versioning(), REACHED)},
                self.valid_from: F.col(self.ts_col),
                self.current: F.lit(False).cast(self.current_type),
            }
        )
        return stack(opened, repeats.select(*shown))

    def merge_every_change(self, dim: DataFrame, staging: DataFrame, work: str) -> DataFrame:
        """The whole dimension after the batch, a version for each change in it.

        Versions of ``dim`` are taken as they are where no incoming row falls before a key's
        last one; else the key's history is made anew from its versions and the batch.
        """
        own = [c for c in dim.columns if c not in self.versioning()]
        batch = staging.select(*[required(k, dim.schema[k].dataType) if k in self.keys else F.col(k).cast(dim.schema[k].dataType).alias(k) for k in own])
        write_files(self.first_rows(batch), f"{work}/first")
        first = dim.sparkSession.read.schema(self.first_rows(batch).schema).parquet(f"{work}/first")
        current = dim.filter(self.is_current()).withColumn("_own", self.position(dim))
        write_files(current.join(first, self.keys).filter("_first <= _own").select(*self.keys), f"{work}/late")
        late = dim.sparkSession.read.parquet(f"{work}/late")
        whole = dim.join(late, self.keys, "left_semi")
        last = dim.filter(self.is_current()).join(first, self.keys, "left_semi").join(late, self.keys, "left_anti")
        untouched = stack(
            dim.filter(self.is_current()).join(first, self.keys, "left_anti"),
            dim.filter(~self.is_current()).join(late, self.keys, "left_anti"),
        )
        if self.version:
            # A key without a current row goes on with its numbers.
            counted = dim.groupBy(*self.keys).agg(F.max(self.version).cast("long").alias("_base")).join(late, self.keys, "left_anti")
            gone = counted.join(dim.filter(self.is_current()).select(*self.keys), self.keys, "left_anti")
            batch = batch.join(gone, self.keys, "left").select(*own, "_base")
        else:
            batch = batch.withColumn("_base", F.lit(None).cast("long"))
        rows = stack(
            whole.select(*own, F.lit(True).alias("_stored"), F.lit(None).cast("long").alias("_base")),
            last.select(*own, F.lit(True).alias("_stored"), self.versions_before().alias("_base")),
            batch.select(*own, F.lit(False).alias("_stored"), "_base"),
        )
        merged = self.spliced(rows, own, work).filter(OPENS)
        typed = merged.select(*[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
        return stack(untouched, typed)

    def versions_before(self) -> Column:
        """Number of the key's versions before a current row."""
        return (F.col(self.version) - 1).cast("long") if self.version else F.lit(None).cast("long")

    def current_view(self, dim: DataFrame) -> DataFrame:
        return dim.filter(self.is_current())

    def history_view(self, dim: DataFrame) -> DataFrame:
        """Every version in the order of key and start."""
        return dim.orderBy(*self.keys, self.valid_from)
