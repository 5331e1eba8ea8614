"""N-gram Jaccard join by parity sketches.

A text's set is its distinct shingles of ``width`` words; two sets are linked when their Jaccard
similarity reaches ``percent``. ``WIDTH`` and ``PERCENT`` are the values of ``op4_parity``; other
callers pass their own. A text's sketch is a row of words; each
shingle falls into one word by its hash and is XORed into it. A word is the parity of the
shingles that fall there, so it differs between two sketches only if some shingle is in one
set and not in the other: the number of differing words is at most the symmetric difference.

Sizes are cut into bands. Two sets that reach the threshold, the smaller of a band's size,
differ in at most D shingles. With D + 1 + E words per sketch at least E + 1 words agree
(pigeonhole), so every linked pair agrees in E + 1 keys (band, place, word). In the order
of how frequent keys are, each text may leave out its E most frequent keys: of E + 1 common
keys at least the rarest stays on both sides. So words that are empty or hold a shingle of a
widespread passage do not form large groups, and texts with few shared keys drop out.

The pairs that meet under a key are verified on the exact sets. Links are needed up to
connection only: rounds compare the members of a key with one hub of another component,
and components are merged after each round. Then the pairs under one key that are still in
different components are compared by bit sketches, in which each shingle flips one bit: the
bits that differ are at most the symmetric difference, so a pair with too many is no link.
This happens within blocks of at most ``2 * BLOCK`` texts. At first a block gives only pairs
that would join two components, fewer than its texts; most of them are links. Once these
are merged, all pairs that the sketches cannot tell apart go on to be verified: those that are
no links and those few that the joining left. No link between different texts is lost, and
texts that are linked already are not compared again, so a group of copies costs its size.
Texts with equal sets are one class from the start.

Sketches are computed where the text is read. Their keys lie in ``SLICES`` columns by hash,
and one slice after the other is joined, so that the shuffle files on disk are those of one
slice. Keys are counted with combining in the map tasks; joins leave hot keys to the adaptive
skew join. Of keys with the same texts (compared by 128 bits of hashes) one goes on: the
others name the same pairs. Sets are built for texts that still have keys only. Shingles are
compared by 64-bit hashes.

Edge cases: null texts and texts without words have an empty set and no links; fewer words
than ``width`` are one shingle; repeated rows are one class; the id of a component is the
smallest id in it, null only if it has no other; an empty table gives an empty result; extra
columns are ignored (``first_of_each`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import Rolling, Scratch, Words, free_name, frugal, lowered, mix, signed, text_slices
from tidemark.llm.components import components
from tidemark.llm.paths import row_key, windows_of

WIDTH = 4
PERCENT = 85
ROUNDS = 2
JOINING = 2
BLOCK = 1500
SLICE = 1 << 18
SLICES = 4
U = np.uint64
BAND_BITS = 6
KEYS = [f"keys_{place}" for place in range(SLICES)]


@dataclass(frozen=True)
class Bands:
    """Band g holds sizes lows[g] .. lows[g + 1] - 1; pairs are joined in the smaller one's band."""

    lows: list[int]
    words: list[int]  # words per sketch; 0 where only equal sets can be linked
    spare: list[int]  # E
    reach: list[int]  # the largest size that may be linked to a set of the band


def bands_for(percent: int = PERCENT) -> Bands:
    lows = [1]
    while len(lows) < 1 << BAND_BITS:
        lows.append(max(lows[-1] + 1, -(-lows[-1] * 10_000 // percent**2)))
    out = Bands(lows[:-1], [], [], [])
    for high in (low - 1 for low in lows[1:]):
        most = (100 - percent) * high // percent
        spare = (most + 1) // 10 + 1 if most >= 4 else 0
        out.words.append(most + 1 + spare if most else 0)
        out.spare.append(spare)
        out.reach.append(high * 100 // percent)
    return out


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text and the text each belongs to, in order of both."""
    data = lowered(data)
    words = Words(data, offsets)
    count = np.diff(words.first)
    starts, owner = windows_of(count, words.first[:-1], width)
    ends = starts + width
    short = np.flatnonzero((count > 0) & (count < width))
    starts, ends = np.concatenate((starts, words.first[short])), np.concatenate((ends, words.first[short] + count[short]))
    owner = np.concatenate((owner, short))
    found = Rolling(words.hashes(data)).of(starts, ends)
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[new], owner[new]


def fingerprints(found: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and hash of each text's set."""
    sizes = np.bincount(owner, minlength=n)
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, owner, mix(found ^ U(0x5851F42D4C957F2D)))
    return sizes, mix(sums + sizes.astype(np.uint64))


def keys_of(found: np.ndarray, owner: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all texts in the bands they take part in, and the text of each key."""
    lows, words, reach = np.array(bands.lows), np.array(bands.words), np.array(bands.reach)
    own = np.searchsorted(lows, sizes, "right") - 1
    out, texts = [], []
    for back in (0, 1):
        band = own - back
        taking = (sizes > 0) & (band >= 0)
        band = np.maximum(band, 0)
        taking &= (sizes <= reach[band]) | (back == 0)
        width = np.where(taking, words[band], 0)
        base = np.concatenate(([0], np.cumsum(width)))
        sketch = np.zeros(base[-1], np.uint64)
        mine = width[owner] > 0
        h, o = found[mine], owner[mine]
        place = ((h >> U(32)) * width[o].astype(np.uint64)) >> U(32)
        np.bitwise_xor.at(sketch, base[o] + place.astype(np.int64), mix(h))
        text = np.repeat(np.arange(len(sizes)), width)
        at = np.arange(len(text)) - base[text]
        where = (band[text].astype(np.uint64) << U(40)) | at.astype(np.uint64)
        key = mix(sketch ^ mix(where)) & ~U((1 << BAND_BITS) - 1)
        out.append(key | band[text].astype(np.uint64))
        texts.append(text)
    key, text = np.concatenate(out), np.concatenate(texts)
    order = np.argsort(text, kind="stable")
    return key[order], text[order]


def _sketches(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    bands = bands_for(percent)
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch, size=SLICE):
            found, owner = shingles(data, offsets, width)
            sizes, prints = fingerprints(found, owner, hi - lo)
            key, text = keys_of(found, owner, sizes, bands)
            lists = [_listed(key[at], text[at], hi - lo) for at in _slices(key)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(sizes.astype(np.int64)), pa.array(signed(prints), mask=sizes == 0), *lists],
                names=["doc_id", "row_key", "n_shingles", "print", *KEYS],
            )


def _slices(key: np.ndarray) -> list[np.ndarray]:
    """Which keys lie in each slice; the bits below ``BAND_BITS`` are the band's."""
    own = (key >> U(BAND_BITS)) % U(SLICES)
    return [own == U(place) for place in range(SLICES)]


def _listed(key: np.ndarray, text: np.ndarray, n: int) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(key)))


def bit_sketch(members: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit; the number of bits follows the size."""
    bits = 64
    while bits < 3 * len(members):
        bits *= 2
    flips = np.bincount((members & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """A sketch as words, folded to ``size`` bytes; that is the sketch with so many bits."""
    words = np.frombuffer(sketch, np.uint64)
    while len(words) * 8 > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in text_slices(batch, size=SLICE):
            found, owner = shingles(data, offsets, width)
            sizes, prints = fingerprints(found, owner, hi - lo)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            body = [found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            bits = [bit_sketch(found[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            columns = [pa.array(signed(prints)), pa.array(sizes.astype(np.int64)), pa.array(body, pa.binary()), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["print", "size", "members", "bits"])


def close_pairs(prints: np.ndarray, labels: np.ndarray, sizes: np.ndarray, bits: list[bytes], percent: int = PERCENT):
    """Pairs of one block in different components that their bit sketches allow to be linked.

    They come as a row number and the later rows it is close to.
    """
    width = min(map(len, bits))
    sketch = np.stack([folded(b, width) for b in bits])
    step = max(1, (1 << 21) // sketch.size)
    order = np.arange(len(prints))
    for lo in range(0, len(prints), step):
        differing = np.bitwise_count(sketch[lo : lo + step, None, :] ^ sketch[None, :, :]).sum(2, dtype=np.int64)
        near = (100 + percent) * differing <= (100 - percent) * (sizes[lo : lo + step, None] + sizes[None, :])
        near &= (labels[lo : lo + step, None] != labels[None, :]) & (order[lo : lo + step, None] < order[None, :])
        for a in np.flatnonzero(near.any(1)):
            yield int(a) + lo, np.flatnonzero(near[a])


def joining(pairs, labels: np.ndarray):
    """Of the pairs those that join two components when taken in turn: fewer than rows."""
    labels = labels.copy()
    for a, others in pairs:
        others = others[labels[others] != labels[a]]
        _, first = np.unique(labels[others], return_index=True)
        if len(first):
            labels[np.isin(labels, labels[others[first]])] = labels[a]
            yield a, others[first]


def _close(batches: Iterator[pa.RecordBatch], percent: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block; a block is gathered and compared when the next one begins."""
    held: list[pa.RecordBatch] = []
    current = None

    def compared() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        prints, labels, sizes = (rows.column(c).to_numpy() for c in ("print", "label", "size"))
        found = close_pairs(prints, labels, sizes, rows.column("bits").to_pylist(), percent)
        for a, b in found if whole else joining(found, labels):
            columns = [np.full(len(b), prints[a]), prints[b], np.full(len(b), labels[a]), labels[b]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["print", "other", "label", "of"])

    def gathered() -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(compared()), pairs_schema)
        yield from found.combine_chunks().to_batches()

    pairs_schema = pa.schema([(c, pa.int64()) for c in ("print", "other", "label", "of")])
    for batch in batches:
        ids = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
        cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
        bounds = [0, *cuts.tolist(), len(ids)]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            block = tuple(ids[a].tolist())
            if held and block != current:
                yield from gathered()
                held = []
            current = block
            held.append(batch.slice(a, b - a))
    if held:
        yield from gathered()


def block_pairs(rows: DataFrame, sets: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Pairs of ``(key, print, label, n)`` under one key whose bit sketches are close enough.

    A key with more than BLOCK texts is cut into parts, and each two parts are one block. Unless
    the ``whole`` block is asked for, it gives the pairs that join components only.
    """
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("own", own)
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "print", "label")
    rows = rows.join(sets.select("print", "size", "bits"), "print").select("key", "i", "j", "print", "label", "size", "bits")
    rows = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return rows.mapInArrow(frugal(lambda batches: _close(batches, percent, whole)), "print long, other long, label long, of long")


def linked(a: bytes, b: bytes, percent: int = PERCENT) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        same = [linked(a.as_py(), b.as_py(), percent) for a, b in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(same, pa.bool_()))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The labels ``(a, b)`` of the pairs of prints ``(a, b)`` whose sets reach the threshold."""
    left = sets.select(F.col("print").alias("a"), F.col("members").alias("a_members"))
    right = sets.select(F.col("print").alias("b"), F.col("members").alias("b_members"))
    both = pairs.join(left, "a").join(right, "b").select("label_a", "label_b", "a_members", "b_members")
    return both.mapInArrow(frugal(lambda batches: _verified(batches, percent)), "a long, b long")


def candidate_keys(sketches: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """(key, print) under which different sets may be linked."""
    spare = F.array(*[F.lit(e) for e in bands_for(percent).spare])
    slices = []
    for keys in KEYS:
        rows = sketches.select("print", F.explode(keys).alias("key"))
        counts = rows.groupBy(F.col("key").alias("k")).agg(F.min("print").alias("a"), F.max("print").alias("b"), F.count(F.lit(1)).alias("n"))
        counts = counts.filter("a < b").select("k", "n")
        slices.append(scratch.save(rows.join(counts, rows.key == counts.k).select("key", "print", "n").distinct(), "shared"))
    shared = reduce(DataFrame.union, slices)
    band = F.col("key").bitwiseAND(F.lit((1 << BAND_BITS) - 1)).cast("int")
    # A print has at most the keys of its own sketch, so a group is bounded by one text.
    ranked = shared.groupBy("print", band.alias("band")).agg(F.sort_array(F.collect_list(F.struct("n", "key")), asc=False).alias("ranked"))
    left = F.slice("ranked", F.element_at(spare, F.col("band") + 1) + 1, F.greatest(F.size("ranked"), F.lit(1)))
    ranked = scratch.save(ranked.select("print", F.explode(left["key"]).alias("key")), "ranked")
    scratch.drop(*slices)
    kept = scratch.save(of_each_group(ranked), "kept")
    scratch.drop(ranked)
    return kept


def of_each_group(rows: DataFrame) -> DataFrame:
    """The rows ``(print, key)`` of one key of each group of two or more prints."""
    hashes = [F.bit_xor(F.xxhash64("print", F.lit(seed))).alias(f"h{seed}") for seed in (0, 1)]
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *hashes).filter("n > 1")
    chosen = groups.groupBy("n", "h0", "h1").agg(F.min("key").alias("k"))
    return rows.join(chosen, rows.key == chosen.k).select("print", "key")


def links(docs: DataFrame, sketches: DataFrame, kept: DataFrame, scratch: Scratch, width: int, percent: int) -> DataFrame:
    """(node, label): components of prints, for prints with a key in ``kept``."""
    asked = kept.select("print").distinct()
    owners = sketches.groupBy("print").agg(F.min("doc_id").alias("owner")).join(asked, "print", "left_semi")
    owners = owners.select("owner").distinct()
    texts = docs.join(owners, docs.doc_id.eqNullSafe(owners.owner)).select(docs.text)
    sets = texts.mapInArrow(frugal(lambda batches: _sets(batches, width)), "print long, size long, members binary, bits binary")
    sets = scratch.save(sets.join(asked, "print", "left_semi").dropDuplicates(["print"]), "sets")

    labels = scratch.save(asked.select("print", F.col("print").alias("label")), "labels")
    for turn in range(ROUNDS + JOINING + 1):
        rows = kept.join(labels, "print").select("key", "print", "label")
        hub = F.min_by(F.struct(F.col("print").alias("hub"), F.col("label").alias("of")), F.xxhash64("print", F.lit(turn)))
        open_keys = rows.groupBy(F.col("key").alias("k")).agg(
            F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("n"), hub.alias("h")
        )
        open_keys = scratch.save(open_keys.filter("a < b").select("k", "n", "h.*"), "open")
        if open_keys.isEmpty():
            break
        rows = rows.join(open_keys, rows.key == open_keys.k)
        if turn < ROUNDS:
            pairs = rows.filter("label != of").select("print", F.col("hub").alias("other"), "label", "of")
        else:
            last = turn == ROUNDS + JOINING
            pairs = scratch.save(block_pairs(rows.select("key", "print", "label", "n"), sets, percent, last), "close")
        pairs = pairs.groupBy(F.least("print", "other").alias("a"), F.greatest("print", "other").alias("b")).agg(
            F.min(F.least("label", "of")).alias("label_a"), F.max(F.greatest("label", "of")).alias("label_b")
        )
        found = components(scratch.save(verified(pairs, sets, percent), "links"), scratch)
        merged = labels.join(found, labels.label == found.node, "left").select("print", F.coalesce(found.label, labels.label).alias("label"))
        labels = scratch.save(merged, "labels")
    scratch.drop(kept, sets)
    return labels


def grouped(docs: DataFrame, scratch: Scratch, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, row_key, n_shingles and component_id per row of ``docs``."""
    docs = docs.select("doc_id", "text", row_key().alias("row_key"))
    schema = "doc_id long, row_key long, n_shingles long, print long, " + ", ".join(f"{keys} array<long>" for keys in KEYS)
    wide = scratch.save(docs.mapInArrow(frugal(lambda batches: _sketches(batches, width, percent)), schema), "sketches")
    kept = candidate_keys(wide.filter("print IS NOT NULL"), scratch, percent)
    sketches = scratch.save(wide.drop(*KEYS), "texts")
    scratch.drop(wide)
    labels = links(docs, sketches.filter("print IS NOT NULL"), kept, scratch, width, percent).select(F.col("print").alias("p"), "label")
    classes = sketches.filter("print IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("first"))
    named = classes.join(labels, classes.print == labels.p, "left").select("print", "first", F.coalesce("label", "print").alias("label"))
    named = scratch.save(named, "named")
    least = named.groupBy(F.col("label").alias("l")).agg(F.min("first").alias("component"))
    of = scratch.save(named.join(least, named.label == least.l).select(F.col("print").alias("p"), "component"), "components")
    rows = sketches.join(of, F.col("print") == F.col("p"), "left")
    return rows.select("doc_id", "row_key", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def first_of_each(docs: DataFrame, scratch: Scratch, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of each component; all columns stay.

    Texts without words are linked to nothing and stay, and so do rows without id. Rows that
    repeat both the id and the text of a kept document stay with it.
    """
    groups = grouped(docs, scratch, width, percent).filter("component_id < doc_id")
    owner, key = free_name(docs.columns, "__gone"), free_name(docs.columns, "__key")
    gone = groups.select(F.col("doc_id").alias(owner), F.col("row_key").alias(key)).distinct()
    return docs.join(gone, (docs.doc_id == F.col(owner)) & (row_key() == F.col(key)), "left_anti")


def op4_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return grouped(docs, Scratch(spark, "op4")).select("doc_id", "n_shingles", "component_id")
