"""Whitening of embeddings by a bit-sliced scatter matrix.

Every entry c of a vector becomes the integer floor(64 * c) + 1,000,000. The fit list holds each
distinct integer vector once. Per dimension, the list's entries less their smallest value are
cut into bit planes, and each plane of 64 rows is packed into one word. The number of set bits
of the AND of two planes, weighted by the planes' powers of two, gives the exact sum of
products of two dimensions; n * sum(xy) - sum(x) * sum(y) in whole numbers of any length is the
centred scatter, so nothing is rounded before the one division that leads to ``eigh``.

Spark does the work on the rows: the distinct list is a grouping on packed keys (a vector that
stands in a third of all rows sends one row per task), the planes are counted per task in
blocks of bounded size, and the counts are summed per pair of dimensions. Only sums per
dimension and pair of dimensions come to the driver; their number depends on the length of
the vectors alone, as does the size of what is broadcast.

Edge cases: a vector that is null or holds a null, NaN or infinite entry, or one beyond 2**56
whose integer no long holds, is dropped. Vectors must have one length: that of most rows counts
(ties: the longer), others are dropped. Repeated rows and null ids stay. Components without
variance, as those of a single distinct vector, have the eigenvalue 0 and a null ``whitened``.
``deviation`` is a decimal of 38 digits and null beyond; where it does not fit a long, the
query's column is null. An empty table, or one without a usable vector, gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Scratch

SCALE = 64
SHIFT = 1_000_000
LARGEST = float(2**56)
COMPONENTS = 16
LIMB = 40  # sums travel as limbs of so many bits
LIMBS = 5
WORKING = 8 << 20  # bytes of bit planes that are compared at once
ROUNDING = 64 * np.finfo(float).eps  # eigenvalues below this share of the largest count as 0


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


@dataclass(frozen=True)
class Packing:
    """Vectors as bytes: entries less the dimension's least value, in the fewest whole bytes."""

    lows: np.ndarray  # int64, least entry per dimension
    width: int

    @staticmethod
    def of(lows: list[int], highs: list[int]) -> Packing:
        most = max(h - low for h, low in zip(highs, lows))
        return Packing(np.array(lows, np.int64), next(w for w in (1, 2, 4, 8) if most < 256**w))

    @property
    def dimension(self) -> int:
        return len(self.lows)

    def pack(self, x: np.ndarray) -> np.ndarray:
        """Rows of int64 to rows of bytes."""
        above = (x.astype(np.uint64) - self.lows.astype(np.uint64)).astype(f"<u{self.width}")
        return np.ascontiguousarray(above).view(np.uint8).reshape(len(x), -1)

    def unpack(self, column: pa.Array) -> np.ndarray:
        """Packed rows to entries above ``lows`` as uint64."""
        size = self.dimension * self.width
        fixed = column.cast(pa.binary(size))
        data = np.frombuffer(fixed.buffers()[1], np.uint8)[fixed.offset * size : (fixed.offset + len(fixed)) * size]
        return data.view(f"<u{self.width}").reshape(-1, self.dimension).astype(np.uint64)


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """A list column whose lists all have ``dimension`` entries, as rows of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def chunked(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Array]:
    """The first column in arrays of at most ``rows`` rows; small batches are joined."""
    held: list[pa.Array] = []
    for batch in batches:
        column = batch.column(0)
        while len(column):
            room = rows - sum(map(len, held))
            held.append(column[:room])
            column = column[room:]
            if sum(map(len, held)) == rows:
                yield pa.concat_arrays(held)
                held = []
    if held:
        yield pa.concat_arrays(held)


def plane_words(entries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bit planes that hold a set bit, with the bit and the dimension of each."""
    planes, of_bit, of_dimension = [], [], []
    padding = -len(entries) % 64
    for bit in range(bits):
        plane = ((entries >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)
        live = np.flatnonzero(plane.any(axis=0))
        packed = np.packbits(np.pad(plane[:, live], ((0, padding), (0, 0))), axis=0)
        planes.append(np.ascontiguousarray(packed.T).view(np.uint64))
        of_bit.append(np.full(len(live), bit))
        of_dimension.append(live)
    return np.concatenate(planes), np.concatenate(of_bit), np.concatenate(of_dimension)


class Scatter:
    """Set bits of ANDs of bit planes, summed per weight and pair of dimensions."""

    def __init__(self, dimension: int, bits: int):
        self.dimension, self.bits = dimension, bits
        self.pairs = np.zeros((2 * bits - 1, dimension, dimension), np.int64)
        self.singles = np.zeros((bits, dimension), np.int64)

    def add(self, entries: np.ndarray) -> None:
        words, bit, dimension = plane_words(entries, self.bits)
        for p in range(len(words)):
            counts = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
            self.singles[bit[p], dimension[p]] += counts[0]
            # A pair of planes counts for both orders of its dimensions; a plane with itself once.
            np.add.at(self.pairs, (bit[p] + bit[p:], dimension[p], dimension[p:]), counts)
            np.add.at(self.pairs, (bit[p] + bit[p + 1 :], dimension[p + 1 :], dimension[p]), counts[1:])

    def totals(self) -> Iterator[tuple[int, int, int]]:
        """(j, k, sum of products) for j <= k, and (-1, j, sum) per dimension."""
        for j in range(self.dimension):
            yield -1, j, weighted(self.singles[:, j])
            for k in range(j, self.dimension):
                yield j, k, weighted(self.pairs[:, j, k])


def weighted(counts: np.ndarray) -> int:
    return sum(int(c) << level for level, c in enumerate(counts) if c)


@dataclass(frozen=True)
class Whitening:
    """What the fit list determines; x is the integer vector, S its sum over the list."""

    packing: Packing
    n: int
    sums: list[int]  # per dimension, of the entries less their least value
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column for each component
    trace: float

    @property
    def components(self) -> int:
        return len(self.values)

    def centred(self, above: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: int64 where that holds it, else Python's integers."""
        most = max(max(self.sums), self.n * (256**self.packing.width - 1))
        if most < 2**62:
            return above.astype(np.int64) * self.n - np.array(self.sums, np.int64)
        return above.astype(object) * self.n - np.array(self.sums, object)

    def scores(self, centred: np.ndarray) -> np.ndarray:
        """The whitened components of the rows; NaN where a component has no variance."""
        scale = np.where(self.values > 0, 1 / np.sqrt(np.where(self.values > 0, self.values, 1)), np.nan)
        return (centred.astype(float) / self.n) @ self.vectors * scale


def deviations(centred: np.ndarray) -> pa.Array:
    """Sums of squares per row as decimals."""
    if centred.dtype != object:
        most = int(np.abs(centred).max(initial=0))
        if most * most * centred.shape[1] < 2**63:
            return pa.array((centred * centred).sum(axis=1)).cast(pa.decimal128(38, 0))
        # Halves of 31 bits: sums of their products fit, and only one step per row is Python's.
        high, low = centred >> 31, centred & (2**31 - 1)
        parts = [(a.astype(object) * b).sum(axis=1) for a, b in ((high, high), (high, low), (low, low))]
        squares = [(int(a) << 62) + (int(b) << 32) + int(c) for a, b, c in zip(*parts)]
    else:
        squares = [sum(int(v) * int(v) for v in row) for row in centred]
    return pa.array([Decimal(v) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))


def prepared(vectors: DataFrame, vector: str, scratch: Scratch, *keep: str) -> DataFrame:
    """The kept columns and ``x``, the integer vector, of the usable rows; stored once."""
    column = F.col(f"`{vector}`")
    rows = vectors.filter(usable(column)).select(*keep, integers(column).alias("x"))
    rows = scratch.save(rows, "integers")
    lengths = rows.groupBy(F.size("x").alias("length")).count().agg(F.max_by("length", F.struct("count", "length")).alias("length"))
    length = lengths.first().length
    return rows.filter(F.size("x") == (length or 0))


def packing_of(rows: DataFrame) -> Packing | None:
    """From the least and the greatest entry of each dimension; None without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0), len(batch.column(0)[0]))
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(low))), pa.array(low), pa.array(high)], names=["j", "low", "high"])

    ranges = rows.select("x").mapInArrow(run, "j long, low long, high long")
    found = ranges.groupBy("j").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("j").collect()
    return Packing.of([r.low for r in found], [r.high for r in found]) if found else None


def fit_list(rows: DataFrame, packing: Packing, scratch: Scratch) -> DataFrame:
    """Each distinct vector once, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = packing.dimension * packing.width
        for batch in batches:
            packed = packing.pack(matrix(batch.column(0), packing.dimension))
            fixed = pa.Array.from_buffers(pa.binary(size), len(packed), [None, pa.py_buffer(packed.tobytes())])
            yield pa.RecordBatch.from_arrays([fixed.cast(pa.binary())], names=["packed"])

    return scratch.save(rows.select("x").mapInArrow(run, "packed binary").distinct(), "fit-list")


def in_few_tasks(listed: DataFrame, n: int, dimension: int) -> DataFrame:
    """At most a few tasks per core, and none for fewer rows than it gives sums.

    Each task gives a sum for every pair of dimensions, however few its rows are.
    """
    most = 4 * listed.sparkSession.sparkContext.defaultParallelism
    return listed.coalesce(min(most, n // dimension**2 + 1))


def sums_of_products(listed: DataFrame, n: int, packing: Packing, bits: int) -> dict[tuple[int, int], int]:
    """(j, k) to the sum of products over the list, (-1, j) to the sum; exact."""
    planes = packing.dimension * bits
    block = 64 * max(1, WORKING // (8 * planes))
    limbs = [f"l{i}" for i in range(LIMBS)]
    mask = (1 << LIMB) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scatter = Scatter(packing.dimension, bits)
        for column in chunked(batches, block):
            scatter.add(packing.unpack(column))
        found = list(scatter.totals())
        columns = [pa.array([f[i] for f in found], pa.int32()) for i in (0, 1)]
        columns += [pa.array([f[2] >> (LIMB * i) & mask for f in found], pa.int64()) for i in range(LIMBS)]
        yield pa.RecordBatch.from_arrays(columns, names=["j", "k", *limbs])

    schema = "j int, k int, " + ", ".join(f"{c} long" for c in limbs)
    parts = in_few_tasks(listed, n, packing.dimension).mapInArrow(run, schema)
    rows = parts.groupBy("j", "k").agg(*[F.sum(c).alias(c) for c in limbs]).collect()
    return {(r.j, r.k): reduce(add, (r[c] << (LIMB * i) for i, c in enumerate(limbs))) for r in rows}


def fit(rows: DataFrame, scratch: Scratch, components: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """The whitening of prepared rows, and the packed fit list; None without rows."""
    packing = packing_of(rows)
    if packing is None:
        return None
    listed = fit_list(rows, packing, scratch)
    n, d = listed.count(), packing.dimension
    found = sums_of_products(listed, n, packing, 8 * packing.width)
    sums = [found[-1, j] for j in range(d)]
    scatter = np.empty((d, d))
    for j in range(d):
        for k in range(j, d):
            # Whole numbers up to here; Python's division rounds once.
            scatter[j, k] = scatter[k, j] = (n * found[j, k] - sums[j] * sums[k]) / (n * n)
    values, vectors = np.linalg.eigh(scatter)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    values = np.where(values > ROUNDING * max(values[0], 0), values, 0.0)
    return Whitening(packing, n, sums, values, np.ascontiguousarray(vectors), float(np.trace(scatter))), listed


def identity_error(model: Whitening, listed: DataFrame) -> float | None:
    """Largest entry of the whitened list's covariance minus the identity, measured on the list."""
    live = np.flatnonzero(model.values > 0)
    if not len(live):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(live) + 1, len(live)))
        for column in chunked(batches, 1 << 15):
            y = model.scores(model.centred(model.packing.unpack(column)))[:, live]
            total[:-1] += y.T @ y
            total[-1] += y.sum(axis=0)
        rows, columns = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(rows.ravel()), pa.array(columns.ravel()), pa.array(total.ravel())], names=["j", "k", "v"])

    sums = np.zeros((len(live) + 1, len(live)))
    parts = in_few_tasks(listed, model.n, model.packing.dimension).mapInArrow(run, "j long, k long, v double")
    for r in parts.groupBy("j", "k").agg(F.sum("v").alias("v")).collect():
        sums[r.j, r.k] = r.v
    mean = sums[-1] / model.n
    return float(np.abs(sums[:-1] / model.n - np.outer(mean, mean) - np.eye(len(live))).max())


SCORES = "component int, deviation decimal(38,0), whitened double, explained double"


def transform(rows: DataFrame, model: Whitening, id_col: str) -> DataFrame:
    """Per row and component: id, component, deviation, whitened and explained."""
    kind = rows.schema[id_col].dataType.simpleString()
    explained = model.values / model.trace if model.trace > 0 else np.full(model.components, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1 << 13):
                part = batch.slice(lo, 1 << 13)
                x = matrix(part.column(1), model.packing.dimension)
                centred = model.centred(x.astype(np.uint64) - model.packing.lows.astype(np.uint64))
                scores = model.scores(centred).ravel()
                repeated = pa.array(np.repeat(np.arange(len(x)), model.components))
                number = np.tile(np.arange(1, model.components + 1, dtype=np.int32), len(x))
                share = np.tile(explained, len(x))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(repeated),
                        pa.array(number),
                        deviations(centred).take(repeated),
                        pa.array(scores, mask=np.isnan(scores)),
                        pa.array(share, mask=np.isnan(share)),
                    ],
                    names=["id", "component", "deviation", "whitened", "explained"],
                )

    return rows.select(F.col(f"`{id_col}`"), "x").mapInArrow(run, f"id {kind}, {SCORES}").withColumnRenamed("id", id_col)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "op11")
    rows = prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", scratch, "vec_id")
    fitted = fit(rows, scratch)
    if fitted is None:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], schema)
    model, listed = fitted
    error = identity_error(model, listed)
    return transform(rows, model, "vec_id").select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
