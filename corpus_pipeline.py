"""The corpus pipeline: a chain of stages over ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import langid, mixing, parity, paths, pieces
from tidemark.llm.common import Scratch, columns_of

# Near copies share 80 percent of their shingles of five words (op4_parity has values of its own).
SHINGLE_WORDS = 5
NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents at hand; drop those whose language is not certain."""
    rows = docs.select(F.struct(*columns_of(docs)).alias("row"), "text")
    found = langid.predict(rows, langid.fit(docs))
    return found.filter("NOT __language.rejected").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    return parity.first_of_each(docs, Scratch(spark, "near-duplicates"), SHINGLE_WORDS, NEAR_PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words of passages of 50 words or more that an earlier document has."""
    cut = paths.cut(docs, Scratch(spark, "repeated-passages"))
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix the sources to their target weights; documents repeat as the rates say."""
    return mixing.mix(docs, Scratch(spark, "mixing"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as piece ids."""
    return pieces.encode(docs, pieces.public_model())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# Compression, XOR sketches and Viterbi have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written as Parquet and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
