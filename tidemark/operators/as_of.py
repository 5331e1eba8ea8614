"""The version that was valid at a fact's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.carry import carry, laid_out


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    fact_time: str,
    valid_from: str,
    valid_to: str,
    take: list[str],
    path: str,
    seq: str | None = None,
) -> DataFrame:
    """Every fact with the ``take`` columns of its key's version at ``fact_time``.

    Facts and versions are stacked, range-partitioned by key and time, and the last version
    is carried on to the facts behind it, over partition borders too. There is no join on a
    range of times, so nothing grows with the versions of a key, and a key with a third of the
    facts is many tasks' work. Intervals are half-open; NULL as their end is open. Of versions
    that start together the one with the greatest ``seq`` counts. A fact before the first
    version, in a gap, without a time or without a key gets NULLs.
    """
    kind = facts.schema[fact_time].dataType
    found = F.struct(F.col(valid_to).alias("ends"), *[F.col(c).alias(f"t_{i}") for i, c in enumerate(take)])
    nothing = F.lit(None)
    starts = versions.filter(F.col(valid_from).isNotNull()).select(
        *[F.col(k).cast(facts.schema[k].dataType).alias(f"k_{i}") for i, k in enumerate(keys)],
        F.col(valid_from).cast(kind).alias("at"),
        (F.col(seq) if seq else F.lit(0)).cast("long").alias("seq"),
        found.alias("version"),
    )
    rows = facts.select(
        *[F.col(k).alias(f"k_{i}") for i, k in enumerate(keys)],
        F.col(fact_time).alias("at"),
        nothing.cast("long").alias("seq"),
        F.struct(*facts.columns).alias("fact"),
    )
    by = [f"k_{i}" for i in range(len(keys))]
    # At the same time a version comes before the facts; rows that tie beyond that are facts.
    both = starts.unionByName(rows, allowMissingColumns=True).withColumns(
        {"is_fact": F.col("fact").isNotNull(), "tie": F.monotonically_increasing_id()}
    )
    order = ["at", "is_fact", "seq", "tie"]
    carried = carry(laid_out(both, by, order, path), by, order, last={"valid": F.col("version")}).filter("is_fact")
    inside = F.col("valid").isNotNull() & F.col("at").isNotNull() & (F.col("valid.ends").isNull() | (F.col("at") < F.col("valid.ends")))
    for k in by:
        inside &= F.col(k).isNotNull()
    taken = [F.when(inside, F.col(f"valid.t_{i}")).alias(c) for i, c in enumerate(take)]
    return carried.select(*[F.col(f"fact.{c}").alias(c) for c in facts.columns], *taken)
