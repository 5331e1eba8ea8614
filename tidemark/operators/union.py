"""Set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name, in the column order of the first frame."""
    return reduce(lambda above, below: above.unionByName(below), frames)


def align(df: DataFrame, target: DataFrame) -> DataFrame:
    """The columns of ``target``, cast to its types where they differ."""
    mine = dict(df.dtypes)
    return df.select(*(df[c] if mine[c] == t else df[c].cast(t).alias(c) for c, t in target.dtypes))
