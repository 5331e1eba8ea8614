"""Repeated word windows, found by compacting the de Bruijn graph of the corpus.

Every window of ``WINDOW`` consecutive words (a token k-mer) is an edge of the graph. The
least hash of the short word sequences inside a window is its minimizer; consecutive windows
of a text with one minimizer form a path (a super-k-mer). Equal windows have equal
minimizers, so they meet when paths are grouped by minimizer:

* a minimizer in one document only has no repeated window;
* if all paths of a minimizer are equal, they are one nonbranching path: its windows are
  repeated everywhere, and the document with the smallest id keeps them;
* otherwise the graph may branch there, and these paths alone are expanded into their
  windows, which are joined on their own hashes.

A path is known by its source coordinates, so the spans to remove are cut from the source
texts by position. Only (minimizer, path hash, id) of about every 22nd window is shuffled,
and groups are combined in the map tasks: a passage in a third of all documents is one row
per task. Matching is by 64-bit hashes of word sequences.

Edge cases: null or short texts have no windows and keep all words; rows without id neither
lose words nor count as a source; repeated rows of one id do not count as each other's
source and get equal results; an empty table gives an empty result; ``removed_words`` and
``cut`` carry extra columns whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Rolling, Scratch, Words, columns_of, frugal, ragged, signed, text_slices

WINDOW = 50
SEED = 8

PATHS = "doc_id long, row_key long, minimizer long, path long, lo int, hi int"


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    least, span = values, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def windows_of(count: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows and the text each lies in, for texts of ``count`` tokens from ``first``."""
    n = np.maximum(count - window + 1, 0)
    return ragged(first, n), np.repeat(np.arange(len(count)), n)


def paths(seeds: np.ndarray, starts: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut the windows into paths: index of each path's first and last window, and minimizers."""
    least = sliding_least(seeds, width)[starts]
    cut = np.ones(len(starts), bool)
    cut[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(starts)) - 1
    return first, last, least[first]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
        for lo, _, data, offsets in text_slices(batch):
            words = Words(data, offsets)
            starts, owner = windows_of(np.diff(words.first), words.first[:-1], WINDOW)
            if not len(starts):
                continue
            rolling = Rolling(words.hashes(data))
            at = np.arange(len(words.starts) - SEED + 1)
            first, last, least = paths(rolling.of(at, at + SEED), starts, owner, WINDOW - SEED + 1)
            begin, end, text = starts[first], starts[last], owner[first]
            base = words.first[text]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[lo + text]),
                    pa.array(keys[lo + text]),
                    pa.array(signed(least)),
                    pa.array(signed(rolling.of(begin, end + WINDOW))),
                    pa.array((begin - base).astype(np.int32)),
                    pa.array((end - base).astype(np.int32)),
                ],
                names=["doc_id", "row_key", "minimizer", "path", "lo", "hi"],
            )


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every window in the given paths of each text."""
    for batch in batches:
        ids, keys, spans = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
        for lo, hi, data, offsets in text_slices(batch):
            words = Words(data, offsets)
            flat, ends = spans[lo:hi].flatten(), np.diff(spans[lo:hi].offsets.to_numpy())
            text = np.repeat(np.arange(hi - lo), ends)
            begin, end = flat.field("lo").to_numpy().astype(np.int64), flat.field("hi").to_numpy().astype(np.int64)
            n = end - begin + 1
            at, text = ragged(begin, n), np.repeat(text, n)
            found = at + words.first[text]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[lo + text]),
                    pa.array(keys[lo + text]),
                    pa.array(signed(Rolling(words.hashes(data)).of(found, found + WINDOW))),
                    pa.array(at.astype(np.int32)),
                ],
                names=["doc_id", "row_key", "edge", "lo"],
            )


def row_key(text: str = "text") -> Column:
    """Tells rows of one id apart; rows equal in id and text need not be."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def removed_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, row_key and the sorted ``spans`` (lo, hi) of repeated windows' first words.

    A span covers the words lo .. hi + WINDOW - 1. Rows without such a span are left out.
    """
    rows = docs.select("doc_id", row_key().alias("row_key"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    found = scratch.save(rows.mapInArrow(frugal(_paths), PATHS), "paths")
    shared = (
        found.groupBy("minimizer")
        .agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min("path").alias("a"), F.max("path").alias("b"))
        .filter("source < last")
        .select(F.col("minimizer").alias("of"), "source", (F.col("a") != F.col("b")).alias("branching"))
    )
    met = found.join(shared, found.minimizer == shared.of).select("doc_id", "row_key", "lo", "hi", "source", "branching")
    met = scratch.save(met, "met")
    scratch.drop(found)
    whole = met.filter("NOT branching AND doc_id > source").select("doc_id", "row_key", "lo", "hi")

    unsure = met.filter("branching").groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    texts = rows.join(unsure, ["doc_id", "row_key"]).select("doc_id", "row_key", "text", "spans")
    edges = scratch.save(texts.mapInArrow(frugal(_windows), "doc_id long, row_key long, edge long, lo int"), "edges")
    sources = edges.groupBy(F.col("edge").alias("of")).agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    sources = sources.filter("source < last")
    single = edges.join(sources, edges.edge == sources.of).filter("doc_id > source").select("doc_id", "row_key", "lo", F.col("lo").alias("hi"))
    spans = whole.unionByName(single).groupBy("doc_id", "row_key").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"))
    spans = scratch.save(spans, "spans")
    scratch.drop(met, edges)
    return spans


def kept_mask(n: int, spans: pa.Array | None, window: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(change, spans.field("lo").to_numpy(), 1)
        np.add.at(change, np.minimum(spans.field("hi").to_numpy() + window, n), -1)
    return np.cumsum(change[:-1]) == 0


def kept_words(data: bytes, spans: pa.Array | None) -> tuple[int, list[bytes]]:
    # bytes.split() separates at the six white-space bytes of the word pattern exactly.
    words = data.split()
    if spans is None or not len(spans):
        return len(words), words
    return len(words), [words[i] for i in np.flatnonzero(kept_mask(len(words), spans, WINDOW))]


def with_spans(docs: DataFrame, spans: DataFrame, more: list[Column] = []) -> DataFrame:
    """text, its spans (null: none) and the given columns of each row."""
    rows = docs.select(F.col("doc_id").alias("__id"), row_key().alias("__key"), F.coalesce("text", F.lit("")).alias("text"), *more)
    on = F.col("__id").eqNullSafe(spans.doc_id) & (F.col("__key") == spans.row_key)
    return rows.join(spans, on, "left").drop(spans.doc_id, spans.row_key, "__key")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, digests = [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            n, kept = kept_words(text.as_buffer().to_pybytes(), spans.values if spans.is_valid else None)
            counts.append(n)
            removed.append(n - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            if not spans.is_valid:
                texts.append(text.as_py())
            else:
                texts.append(cut_text(text.as_py(), spans.values))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, batch.column(1).type)], names=["row", "text"]
        )


def cut_text(text: str, spans: pa.Array) -> str:
    """The text without its removed words; the white space before a kept word stays."""
    data = text.encode()
    words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    keep = kept_mask(len(words.starts), spans, WINDOW)
    before = np.concatenate(([0], words.ends[:-1]))
    parts = [data[before[i] : words.ends[i]] for i in np.flatnonzero(keep)]
    tail = data[words.ends[-1] :] if len(keep) and keep[-1] else b""
    return (b"".join(parts) + tail).decode()


def cut(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The documents without the words of windows that an earlier document has.

    All rows and columns stay; a text that loses nothing stays as it is.
    """
    spans = removed_spans(docs, scratch)
    others = F.struct(*columns_of(docs, "text")).alias("row")
    rows = with_spans(docs, spans, [others, F.col("text").isNull().alias("no_text")])
    schema = rows.select("row", "text").schema
    new = rows.filter("NOT no_text").select("row", "text", "spans").mapInArrow(frugal(_cut), schema)
    new = new.unionByName(rows.filter("no_text").select("row", F.lit(None).cast("string").alias("text")))
    return new.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op7_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = with_spans(docs, removed_spans(docs, Scratch(spark, "op7")))
    return rows.select("__id", "text", "spans").mapInArrow(
        frugal(_digests), "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
