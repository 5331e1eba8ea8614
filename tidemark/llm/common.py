"""Scratch tables and vectorised text hashing shared by the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path

# White space of the word pattern [^\x20\x09-\x0D]+; all are single bytes in UTF-8.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one run in the folder that all executors share.

    A saved table cuts the lineage: losing an executor later never repeats the work before
    it. Shuffle files of the job that wrote a table go as soon as the table is complete,
    so that a chain of jobs needs the disk of its largest step only.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = scratch_path(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with self.shuffles_removed():
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def shuffles_removed(self) -> Iterator[None]:
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)

    def drop(self, *tables: DataFrame) -> None:
        """Remove saved tables that no later step reads."""
        jvm = self.spark._jvm
        for table in tables:
            for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
                if self.root.rsplit("/", 1)[-1] in folder:
                    path = jvm.org.apache.hadoop.fs.Path(folder)
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(columns: list[str], name: str) -> str:
    """The name, or one made from it that no column has (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame, *without: str) -> list[Column]:
    """The columns of a frame under their own names, which may hold dots."""
    return [df[f"`{c}`"].alias(c) for c in df.columns if c not in without]


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of white-space separated words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- hashing with numpy

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_INVERSE = _U(pow(int(_MULTIPLIER), -1, 2**64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        _powers[kind] = np.multiply.accumulate(table)
    return _powers[kind][:n]


class Rolling:
    """Hashes of any ranges of a sequence of 64-bit values, from one running sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _power("up", _MULTIPLIER, n), out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        down = _power("down", _INVERSE, len(self.sums))
        return mix((self.sums[ends] - self.sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


    def windows(self, width: int) -> np.ndarray:
        """``of`` for all windows of one width."""
        n = max(0, len(self.sums) - width)
        down = _power("down", _INVERSE, len(self.sums))[:n]
        return mix((self.sums[width:] - self.sums[:n]) * down + np.uint64(width))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True


class Words:
    """Words of a run of texts that lie one after the other in ``data``.

    ``first[i]`` is the index of the first word of text ``i``; ``first[-1]`` is their count.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        space = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.ones(len(data), bool)
        before[1:] = space[:-1]
        after = np.ones(len(data), bool)
        after[:-1] = space[1:]
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return Rolling(byte_values(data)).of(self.starts, self.ends)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def text_slices(batch: pa.RecordBatch, column: str = "text", size: int = 1 << 20):
    """Yield ``(lo, hi, data, offsets)`` for runs of rows with about ``size`` bytes of text.

    A null text counts as empty. Working memory follows ``size`` or the longest text.
    """
    texts = batch.column(column)
    texts = texts.fill_null("") if texts.null_count else texts
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return
    _, ends, body = texts.buffers()
    offsets = np.frombuffer(ends, np.int64, n + 1 + texts.offset)[texts.offset :]
    body = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, body[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` for all ``i``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


# What a worker process keeps for later tasks of one operator.
_remembered: dict = {}


def remembered(key, make):
    """What the worker keeps under ``key``, made if need be; what it keeps under another key goes."""
    if key not in _remembered:
        forget()
        _remembered[key] = make()
    return _remembered[key]


def forget() -> None:
    """Drop what tasks of another operator have left: workers outlive the operators."""
    if _remembered:
        _remembered.clear()
        give_back()


def frugal(work):
    """``work`` on batches in a worker that holds nothing else; its memory is given back when a task ends."""

    def run(batches):
        forget()
        yield from work(batches)
        give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
