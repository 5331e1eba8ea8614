"""Key expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, MapType


def surrogate_key(natural: Column, digits: int = 15) -> Column:
    """Deterministic bigint key: the leading hex digits of the key's SHA-256.

    Both fact and dimension derive it on their own, so loading a fact needs no lookup
    join. Fifteen digits are 60 bits and always fit a signed bigint; sixteen would
    overflow for half of all keys.
    """
    if not 1 <= digits <= 15:
        raise ValueError("digits must lie between 1 and 15")
    prefix = F.substring(F.sha2(natural.cast("string"), 256), 1, digits)
    return F.conv(prefix, 16, 10).cast("bigint")


def required(key: str, kind: DataType | None = None) -> Column:
    """The key column; a row without a key fails the job instead of merging with others."""
    checked = F.coalesce(F.col(key), F.raise_error(F.lit(f"a row without a key: {key} is NULL")))
    return (checked if kind is None else checked.cast(kind)).alias(key)


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's values. Maps have no order and are left out."""
    return F.xxhash64(*[f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def tie_break(df: DataFrame, order_cols: list[str]) -> Column:
    """Ordering value that ranks rows by ``order_cols``, then by a hash of the row.

    The hash makes the winner among equal ``order_cols`` depend on the data alone, not
    on the order in which tasks deliver the rows.
    """
    return F.struct(*order_cols, row_hash(df).alias("_row_hash"))


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form that can be hashed and compared: a map as its sorted entries."""
    column = F.col(f"`{name}`")
    return F.array_sort(F.map_entries(column)) if isinstance(df.schema[name].dataType, MapType) else column
