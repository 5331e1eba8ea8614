"""Mixing sources to target weights with whole documents.

Sources in order of their code points (null last) get the weights 1, 2, 3, 1, 2, 3 and so
on and share all words of the corpus; a target stops at ``most`` times the source's own
size, and the excess goes to the others by weight until no target is above its stop. A
source's repetition rate is target / size. Each document is taken floor(rate) times, plus
one hash-seeded Bernoulli copy with probability equal to the fraction.

Everything is DataFrame code. The corpus is read once; only (row, source, size) is kept.
Each source meets its totals in an aggregation combined in the map tasks, so a source with
a third of all rows sends one row per task. The number of sources may grow: they are
ranked by a range-partitioned numbering, never in one task.

The copy draws of one hash seed may miss a target by a few long documents. So ``seeds``
independent draws are summed side by side in one aggregation, and each source uses the one
that ends nearest to its target. Reruns give the same mix.

Edge cases: null or empty texts have size 0 and are taken 0 words (their copies follow the
same rule); a null source is a source of its own; repeated rows draw the same copies; null
ids draw by a fixed hash; a source without words has target and rate 0; an empty table
gives an empty result. Extra columns are carried by ``mix`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Scratch, columns_of, free_name, word_count
from tidemark.operators.numbering import number_rows

SEEDS = 64
MOST = 3


def draw(doc_id: Column, seed: Column | int) -> Column:
    """A number in [0, 1) that depends on the document's id and the seed only."""
    seed = F.lit(seed) if isinstance(seed, int) else seed
    return F.shiftrightunsigned(F.xxhash64(doc_id, seed.cast("int")), 11) / F.lit(float(2**53))


def targets(sizes: DataFrame, scratch: Scratch, most: int = MOST) -> DataFrame:
    """One row per source of ``(source, size)``: source, source_size, target, rate."""
    totals = scratch.save(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "totals")
    # A binary key orders by bytes, which for UTF-8 is the order of code points.
    ranked = number_rows(
        totals.select(F.col("source").isNull().alias("no_source"), F.col("source").cast("binary").alias("key"), "source", "source_size"),
        ["no_source", "key"],
        "n",
        scratch.path("ranked"),
    )
    sources = scratch.save(ranked.select("source", "source_size", ((F.col("n") - 1) % 3 + 1).alias("weight")), "sources")
    level = water_level(sources, most)
    target = F.least(F.col("weight") * F.lit(level), F.lit(float(most)) * F.col("source_size"))
    return sources.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def water_level(sources: DataFrame, most: int) -> float:
    """Words per unit of weight at which the targets sum up to all words.

    Each round stops the sources that are above ``most`` times their size and shares the
    rest by weight; the level only rises, and a round without a new stop is the last.
    """
    whole = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    if not whole.size:
        return 0.0
    level, stopped = whole.size / whole.weight, -1
    cap = F.lit(most) * F.col("source_size")
    while True:
        above = F.col("weight") * F.lit(level) > cap
        now = sources.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("free"),
        ).first()
        if now.n == stopped or not now.free:
            return level
        level, stopped = (whole.size - now.fixed) / now.free, now.n


def source_plan(sizes: DataFrame, scratch: Scratch, seeds: int = SEEDS, most: int = MOST) -> DataFrame:
    """Per source of ``(doc_id, source, size)``: source_size, target, rate and seed."""
    rates = scratch.save(targets(sizes, scratch, most), "rates")
    seed = nearest_seed(sizes, rates, seeds)
    return scratch.save(rates.join(seed, rates.source.eqNullSafe(seed.source)).drop(seed.source), "plan")


def sizes_of(docs: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.save(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")


def copies_of(doc_id: Column, plan: DataFrame) -> Column:
    """floor(rate) plus one hash-seeded copy with the probability of the fraction."""
    extra = draw(doc_id, plan.seed) < plan.rate - F.floor(plan.rate)
    return (F.floor(plan.rate) + extra.cast("long")).cast("long")


def mixing_plan(docs: DataFrame, scratch: Scratch, seeds: int = SEEDS, most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken per document."""
    sizes = sizes_of(docs, scratch)
    plan = source_plan(sizes, scratch, seeds, most)
    copies = copies_of(sizes.doc_id, plan)
    return sizes.join(plan, sizes.source.eqNullSafe(plan.source)).select(
        *[sizes[c] for c in sizes.columns],
        plan.source_size,
        plan.target,
        plan.rate,
        copies.alias("copies"),
        (sizes["size"] * copies).alias("taken"),
    )


def nearest_seed(sizes: DataFrame, rates: DataFrame, seeds: int) -> DataFrame:
    """Per source the seed whose drawn copies end nearest to the target (ties: the least)."""
    fraction = F.col("rate") - F.floor("rate")
    joined = sizes.filter("size > 0").join(rates, sizes.source.eqNullSafe(rates.source)).drop(sizes.source)
    sums = joined.groupBy("source", "source_size", "target", "rate").agg(
        *[F.sum(F.when(draw(F.col("doc_id"), s) < fraction, F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(seeds)]
    )
    wanted = F.col("target") - F.floor("rate") * F.col("source_size")
    miss = [F.struct(F.abs(F.col(f"s{s}") - wanted).alias("miss"), F.lit(s).alias("seed")) for s in range(seeds)]
    best = sums.select("source", F.array_min(F.array(*miss)).getField("seed").alias("seed"))
    rest = rates.filter("source_size = 0").select("source", F.lit(0).alias("seed"))
    return best.unionByName(rest)


def mix(docs: DataFrame, scratch: Scratch, seeds: int = SEEDS, most: int = MOST) -> DataFrame:
    """The documents of the mix, each row as often as the plan takes it."""
    plan = source_plan(sizes_of(docs, scratch), scratch, seeds, most)
    rows = docs.join(plan, docs.source.eqNullSafe(plan.source))
    repeats = F.array_repeat(F.lit(1), copies_of(docs.doc_id, plan).cast("int"))
    copy = free_name(docs.columns, "__copy")
    return rows.select(*columns_of(docs), F.explode(repeats).alias(copy)).drop(copy)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mixing_plan(docs, Scratch(spark, "op9"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")
