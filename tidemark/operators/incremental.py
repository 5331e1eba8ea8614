"""Bounded slices of a changing source.

The change column may be a timestamp, a date or a number; bounds have its kind.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from tidemark.functions import instant


Mark = datetime | date | int | Decimal


def mark(value: Mark, kind: DataType) -> Column:
    """A bound of the change column's type."""
    return instant(value, kind) if isinstance(value, datetime) else F.lit(str(value)).cast(kind)


def incremental_slice(
    df: DataFrame,
    cdc_col: str,
    lo: Mark | None = None,
    hi: Mark | None = None,
    overlap: timedelta | int = timedelta(0),
    with_missing: bool = False,
) -> DataFrame:
    """Rows changed in ``(lo - overlap, hi]``; ``lo=None`` is the full load.

    The upper bound fixes the slice: rows that change while the job runs fall into the
    next one. ``overlap`` reads a little before the bookmark again, for sources whose
    clock is too coarse to tell late commits apart; latest-per-key removes the repeats.
    ``with_missing`` also passes on rows without a change time, so that a job can count
    them instead of losing them.
    """
    kind = df.schema[cdc_col].dataType
    inside = F.lit(True)
    if lo is not None:
        inside &= F.col(cdc_col) > mark(lo - overlap if overlap else lo, kind)
    if hi is not None:
        inside &= F.col(cdc_col) <= mark(hi, kind)
    if lo is None and hi is None:
        return df
    return df.filter(F.col(cdc_col).isNull() | inside) if with_missing else df.filter(inside)


def with_ingest_metadata(df: DataFrame, as_of: datetime) -> DataFrame:
    """Add ``ingested_at`` and ``ingest_date``, the same for every row of the run."""
    stamp = instant(as_of)
    return df.withColumns({"ingested_at": stamp, "ingest_date": F.to_date(stamp)})


def high_watermark(df: DataFrame, cdc_col: str) -> DataFrame:
    """One row: the greatest change time."""
    return df.agg(F.max(cdc_col).alias("high_watermark"))


def batch_summary(batch: DataFrame, cdc_col: str, lo: datetime | None) -> DataFrame:
    """One row: the batch size and the bookmark after it; an empty batch keeps ``lo``."""
    before = instant(lo) if lo is not None else F.lit(None).cast("timestamp_ntz")
    reached = F.max(cdc_col).cast("timestamp_ntz")
    return batch.agg(
        F.count("*").alias("row_count"),
        F.greatest(reached, before).alias("last_value"),
    )


def contract_violations(batch: DataFrame, cdc_col: str, hi: datetime) -> DataFrame:
    """One row: rows without a change time, and rows changed after the slice's end."""
    late = F.col(cdc_col) > instant(hi, batch.schema[cdc_col].dataType)
    return batch.agg(
        F.count_if(F.col(cdc_col).isNull()).alias("without_change_time"),
        F.count_if(late).alias("beyond_upper_bound"),
    )
