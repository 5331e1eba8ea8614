"""Hashed keys for naturals whose hashes collide.

Almost all keys are the hash of their natural, so facts derive them without a lookup. Naturals
that share a hash are registered: the one that had the hash first keeps it, the others get
a key from a second block of digits, below zero and so apart from all hashes. A registered key
never changes, whatever arrives later and in whatever order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import surrogate_key

REGISTRY = "natural string, key bigint"
DIGITS = 15


@dataclass(frozen=True)
class Keys:
    """How naturals become keys: digits of the hash, and the registry per natural column."""

    digits: int = DIGITS
    registries: dict[str, DataFrame] = field(default_factory=dict)

    def add(self, df: DataFrame, natural: str, name: str) -> DataFrame:
        """The frame with the key ``name``, in its place if it is there already."""
        hashed = surrogate_key(F.col(natural), self.digits)
        if natural not in self.registries:
            return df.withColumn(name, hashed)
        # The registry holds colliding naturals only; Spark broadcasts it while it is small.
        found = self.registries[natural].select(F.col("natural").alias("__natural"), F.col("key").alias("__key"))
        joined = df.join(found, F.col(natural).cast("string") == F.col("__natural"), "left")
        return joined.withColumn(name, F.coalesce("__key", hashed)).drop("__natural", "__key")


def second_key(natural: Column, digits: int) -> Column:
    """A key below zero from the digits behind those of the hash."""
    block = F.substring(F.sha2(natural.cast("string"), 256), digits + 1, DIGITS)
    return -F.conv(block, 16, 10).cast("bigint") - 1


def extended(naturals: DataFrame, registry: DataFrame | None, stored: DataFrame | None, digits: int = DIGITS) -> DataFrame:
    """The registry with every natural whose hash another one has.

    ``naturals`` has the column ``natural``; ``stored`` holds natural and key of the stored
    dimension, whose keys stay as they are. Among new naturals the least one gets the hash.
    """
    spark = naturals.sparkSession
    text = F.col("natural").cast("string").alias("natural")
    known = registry if registry is not None else spark.createDataFrame([], REGISTRY)
    stored = stored.select(text, "key") if stored is not None else spark.createDataFrame([], REGISTRY)
    all_keys = known.withColumn("rank", F.lit(0)).unionByName(stored.withColumn("rank", F.lit(1)))
    rows = all_keys.unionByName(naturals.select(text, F.lit(None).cast("bigint").alias("key"), F.lit(2).alias("rank")))
    # One row per natural, with the key that it has already.
    rows = rows.filter("natural IS NOT NULL").groupBy("natural").agg(F.min_by("key", "rank").alias("key"), F.min("rank").alias("rank"))
    rows = rows.withColumn("base", surrogate_key(F.col("natural"), digits))
    taken = (F.col("key") == F.col("base")).cast("int")
    holder = F.min_by("natural", F.struct(F.coalesce(-taken, F.lit(0)), "natural")).alias("holder")
    crowded = rows.groupBy(F.col("base").alias("b")).agg(F.count(F.lit(1)).alias("n"), holder).filter("n > 1")
    met = rows.join(crowded, F.col("base") == F.col("b"))
    made = F.when(F.col("natural") == F.col("holder"), F.col("base")).otherwise(second_key(F.col("natural"), digits))
    return met.select("natural", F.coalesce("key", made).alias("key"))
