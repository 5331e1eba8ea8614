"""Repeated byte strings, removed by suffix arrays over the places where texts may repeat.

Every string of ``WINDOW`` bytes has a minimizer, the least hash of the ``SEED``-byte strings
in it (those that begin with a white-space byte before a word come first). Runs of strings
with one minimizer are regions; equal strings have equal minimizers, so:

* a minimizer in one document only has no repeated string;
* if all regions of a minimizer are equal, the least document keeps them;
* otherwise equal regions are brought together, the least document standing for them, and
  the different regions of a minimizer are laid out in one text whose suffix array
  (``suffixes.suffix_array``) is built. Neighbours in the array that agree in ``WINDOW``
  bytes are one repeated string, and its least document keeps it.

Suffix arrays are built block by block; a block holds whole groups and about ``BLOCK`` bytes.
A group is a minimizer at first. One of more than ``MOST`` bytes (a phrase in a large part of
all documents) is divided: every string holds half of the other bytes either before or behind
the minimizer, so pieces of regions meet by that longer core, then by one longer again, until
a group fits a block or its pieces are one string. Regions are cut at ``LONGEST`` strings.
A region may hold its minimizer, and so a piece, many times: that is one row with all its places.
Before an array is built, strings whose middle ``WINDOW - STEP + 1`` bytes about the minimizer
have one owner are left out, and equal runs of strings are one.
Only (minimizer, id, region hash) of about every 19th string is shuffled, combined in the
map tasks, and only texts with uncertain regions are read again. Regions are compared by
64-bit hashes, strings within a block byte by byte.

Edge cases: null or short texts lose nothing; rows without id neither lose bytes nor count
as a source; repeated rows of one id are no source of each other and get equal results;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import _SPACE, Rolling, Scratch, byte_values, mix, ragged, signed, text_slices
from tidemark.llm.paths import kept_mask, paths, windows_of
from tidemark.llm.suffixes import suffix_array

WINDOW = 50
SEED = 20
BLOCK = 1 << 15
GATHERED = 1 << 20
MOST = 1 << 17
STEP = 4
LONGEST = 2000
GROUPED = ["group", "minimizer", "region", "owner", "at", "core_lo", "core_hi", "content"]
RUNS_SCHEMA = "minimizer long, region long, run array<struct<at: int, upto: int>>"
GROUP_SCHEMA = "group long, minimizer long, region long, owner long, at array<int>, core_lo int, core_hi int, content binary"


def seeds_of(data: np.ndarray, rolling: Rolling) -> np.ndarray:
    seeds = rolling.windows(SEED)
    seeds >>= np.uint64(1)
    space = _SPACE[data]
    early = space[: len(seeds)] & ~space[1 : len(seeds) + 1]
    seeds[~early] |= np.uint64(1 << 63)
    return seeds


def regions_in(data: np.ndarray, offsets: np.ndarray):
    """Text, first and last string, minimizer and hash of each region; None if there is none."""
    starts, owner = windows_of(np.diff(offsets), offsets[:-1], WINDOW)
    if not len(starts):
        return None
    rolling = Rolling(byte_values(data))
    first, last, least = paths(seeds_of(data, rolling), starts, owner, WINDOW - SEED + 1)
    # A text of one repeated byte is one run; cut, so that a region is a few kilobytes at most.
    parts = (last - first) // LONGEST + 1
    run = np.repeat(np.arange(len(first)), parts)
    first = first[run] + (np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)) * LONGEST
    last, least = np.minimum(first + LONGEST - 1, last[run]), least[run]
    begin, end = starts[first], starts[last]
    return owner[first], begin, end, signed(least), signed(rolling.of(begin, end + WINDOW))


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for lo, _, data, offsets in text_slices(batch):
            if (found := regions_in(data, offsets)) is not None:
                text, _, _, least, region = found
                yield pa.RecordBatch.from_arrays(
                    [pa.array(least), pa.array(ids[lo + text]), pa.array(region)], names=["minimizer", "doc_id", "region"]
                )


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for lo, _, data, offsets in text_slices(batch):
            if (found := regions_in(data, offsets)) is not None:
                text, begin, end, least, _ = found
                base = offsets[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo + text]),
                        pa.array(keys[lo + text]),
                        pa.array(least),
                        pa.array((begin - base).astype(np.int32)),
                        pa.array((end - base).astype(np.int32)),
                    ],
                    names=["doc_id", "row_key", "minimizer", "lo", "hi"],
                )


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and hash of the given regions of each text."""
    for batch in batches:
        ids, keys, spans = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
        for lo, hi, data, offsets in text_slices(batch):
            flat, ends = spans[lo:hi].flatten(), np.diff(spans[lo:hi].offsets.to_numpy())
            text = np.repeat(np.arange(hi - lo), ends)
            begin, end = (flat.field(c).to_numpy().astype(np.int64) + offsets[text] for c in ("lo", "hi"))
            size = end - begin + WINDOW
            body = data[ragged(begin, size)].tobytes()
            bounds = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
            for a in range(0, len(text), 50_000):  # a binary array holds 2 GB at most
                b = min(a + 50_000, len(text))
                part = pa.py_buffer(body[bounds[a] : bounds[b]])
                cuts = pa.py_buffer((bounds[a : b + 1] - bounds[a]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo + text[a:b]]),
                        pa.array(keys[lo + text[a:b]]),
                        flat.field("minimizer").slice(a, b - a),
                        pa.array(signed(Rolling(byte_values(data)).of(begin[a:b], end[a:b] + WINDOW))),
                        flat.field("lo").slice(a, b - a),
                        flat.field("hi").slice(a, b - a),
                        pa.Array.from_buffers(pa.binary(), b - a, [None, cuts, part]),
                    ],
                    names=["doc_id", "row_key", "minimizer", "region", "lo", "hi", "content"],
                )


REGIONS = "doc_id long, row_key int, minimizer long, region long, lo int, hi int, content binary"


def repeated_in_block(contents: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content, first and last offset of runs of strings that also start in a content with a smaller owner.

    In the suffix array equal strings are neighbours; the values are shifted by one, and a
    zero behind every content keeps strings within it.
    """
    size = np.array([len(c) for c in contents])
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    data = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8).astype(np.int64) + 1
    data[begin[1:] - 1] = 0
    home = np.repeat(np.arange(len(contents)), size + 1)
    order = np.array(suffix_array(data))
    order = order[order + WINDOW < begin[home[order] + 1]]
    strings = np.lib.stride_tricks.sliding_window_view(data.astype(np.int16), WINDOW)
    new = np.ones(len(order), bool)
    for lo in range(1, len(order), 1 << 14):
        at = order[lo - 1 : lo + (1 << 14)]
        same = strings[at]
        new[lo : lo + len(at) - 1] = (same[1:] != same[:-1]).any(1)
    owner = owners[home[order]]
    least = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
    found = np.sort(order[owner > least])
    first, last = runs_of(found)
    row = home[first]
    return row, first - begin[row], last - begin[row]


def runs_of(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers in ascending ones."""
    cut = np.flatnonzero(np.diff(places) != 1)
    ends = np.append(cut, len(places) - 1) if len(places) else cut
    begins = np.concatenate(([0], cut + 1)) if len(places) else cut
    return places[begins], places[ends]


def least_of(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest owner among the entries of each entry's key."""
    if not len(key):
        return owner, owner
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order[1:]] != key[order[:-1]]))
    which = np.cumsum(new) - 1
    out = []
    for f in (np.minimum, np.maximum):
        values = np.empty_like(owner)
        values[order] = f.reduceat(owner[order], np.flatnonzero(new))[which]
        out.append(values)
    return out[0], out[1]


def cores_of(batch: pa.RecordBatch | pa.Table, group: np.ndarray, data: np.ndarray, begin: np.ndarray, rolling: Rolling):
    """Row, begin and end (within the row) of each core: the given one, or every place of the minimizer."""
    lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("core_lo", "core_hi"))
    row = np.arange(len(lo))
    if not len(lo) or lo[0] >= 0:
        return row, lo, hi
    seeds = signed(seeds_of(data, rolling))
    home = np.repeat(row, np.diff(begin))[: len(seeds)]
    place = np.flatnonzero(seeds == group[home])
    row = home[place]
    place, row = (x[place + SEED <= begin[row + 1]] for x in (place, row))
    return row, place - begin[row], place - begin[row] + SEED


def may_repeat(cores, group: np.ndarray, owners: np.ndarray, begin: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the runs of strings that may start with another owner too.

    Strings that hold a core within the same STEP places of their begin share all but
    STEP - 1 bytes; such a class takes part if these bytes are found with several owners.
    """
    row, lo, hi = cores
    rest = WINDOW - (hi - lo)
    last = begin[row + 1] - WINDOW
    keys, spans = [], []
    for near in range(0, int(rest.max(initial=0)) + 1, STEP):
        far = np.minimum(near + STEP - 1, rest)
        core = begin[row] + lo
        from_, to = np.maximum(core - far, begin[row]), np.minimum(core - near, last)
        ok = (rest >= near) & (from_ <= to)
        r, core = row[ok], core[ok]
        keys.append(mix(rolling.of(core - near, core + WINDOW - far[ok]) ^ mix(group[r].astype(np.uint64) + np.uint64(near))))
        spans.append((r, from_[ok], to[ok]))
    if not keys:
        return np.zeros(0, int), np.zeros(0, int)
    r, from_, to = (np.concatenate(x) for x in zip(*spans))
    least, most = least_of(np.concatenate(keys), owners[r])
    several = least < most
    change = np.zeros(begin[-1] + 1, np.int64)
    np.add.at(change, from_[several], 1)
    np.add.at(change, to[several] + 1, -1)
    return runs_of(np.flatnonzero(np.cumsum(change) > 0))


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by group, as tables of whole groups with about ``GATHERED`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < GATHERED:
            continue
        rows = pa.Table.from_batches(held)
        groups = rows.column("group").to_numpy()
        cut = int(np.searchsorted(groups, groups[-1]))
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut).combine_chunks().to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group; whole groups are sifted and put together into blocks."""
    for rows in whole_groups(batches):
        groups, owners = rows.column("group").to_numpy(), rows.column("owner").to_numpy()
        body = b"".join(contents := rows.column("content").to_pylist())
        data = np.frombuffer(body, np.uint8)
        begin = np.concatenate(([0], np.cumsum([len(c) for c in contents])))
        rolling = Rolling(byte_values(data))
        first, last = may_repeat(cores_of(rows, groups, data, begin, rolling), groups, owners, begin, rolling)
        row = np.searchsorted(begin, first, "right") - 1
        # Of equal runs of one group the least owner's stands for all; the others repeat as a whole.
        equal = mix(rolling.of(first, last + WINDOW) ^ mix(groups[row].astype(np.uint64)))
        whole = owners[row] > least_of(equal, owners[row])[0]
        yield placed(rows, row[whole], first[whole] - begin[row[whole]], last[whole] - begin[row[whole]])
        left = np.flatnonzero(~whole)
        least, most = least_of(groups[row[left]], owners[row[left]])
        left = left[least < most]
        group = groups[row[left]]
        sizes = np.cumsum(last[left] - first[left] + WINDOW)
        a = held = 0
        for i in np.flatnonzero(np.append(group[1:] != group[:-1], True)) if len(left) else ():
            if sizes[i] - held >= BLOCK or i == len(left) - 1:
                part, a, held = left[a : i + 1], int(i) + 1, sizes[i]
                parts = [body[x : y + WINDOW] for x, y in zip(first[part].tolist(), last[part].tolist())]
                home, lo, hi = repeated_in_block(parts, owners[row[part]])
                base = first[part][home] - begin[row[part][home]]
                yield placed(rows, row[part][home], base + lo, base + hi)


def places_of(rows: pa.RecordBatch | pa.Table, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many places the content of each given row has, and these places one after the other."""
    at = rows.column("at")
    n = pc.list_value_length(at).to_numpy().astype(np.int64)
    places = pc.list_flatten(at).to_numpy()
    first = np.cumsum(n) - n
    return n[row], places[ragged(first[row], n[row])]


def placed(rows: pa.Table, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
    n, at = places_of(rows, row)
    run = [pa.array((at + np.repeat(x, n)).astype(np.int32)) for x in (lo, hi)]
    ends = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
    columns = [pa.array(rows.column(c).to_numpy()[row]) for c in ("minimizer", "region")]
    runs = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(run, ["at", "upto"]))
    return pa.RecordBatch.from_arrays([*columns, runs], names=["minimizer", "region", "run"])


def _divided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two pieces of each row around its core, each with a longer core and a group by it.

    A string holds the core and r bytes more. Those with h of them before the core share these,
    the others share r - h + 1 behind it; a core of a whole string is left as it is. Rows without
    a core are whole regions; their cores are the places of the minimizer. Equal pieces of a row
    are given once, with all their places.
    """
    for batch in batches:
        contents = batch.column("content").to_pylist()
        if not contents:
            continue
        data = np.frombuffer(b"".join(contents), np.uint8)
        begin = np.concatenate(([0], np.cumsum([len(c) for c in contents])))
        rolling = Rolling(byte_values(data))
        group = batch.column("group").to_numpy()
        row, lo, hi = cores_of(batch, group, data, begin, rolling)
        size = begin[row + 1] - begin[row]
        rest = WINDOW - (hi - lo)
        half = (rest + 1) // 2
        for side, core_lo, core_hi, last in ((1, lo - half, hi, lo - half), (2, lo, hi + rest - half + 1, lo)):
            first = np.maximum(core_hi - WINDOW, 0)
            last = np.minimum(last, size - WINDOW)
            ok = (first <= last) & (core_lo >= 0) & (core_hi <= size)
            r, a, z, core_lo, core_hi = row[ok], first[ok], last[ok] + WINDOW, core_lo[ok], core_hi[ok]
            base = begin[r]
            of = mix(rolling.of(base + core_lo, base + core_hi) ^ mix(group[r].astype(np.uint64) + np.uint64(side)))
            piece = rolling.of(base + a, base + z)
            order, which = alike(r, of, core_lo - a, piece)
            n, at = places_of(batch, r[order])
            ends = np.bincount(which, n, which[-1] + 1 if len(which) else 0).astype(np.int64)
            at = pa.array((at + np.repeat(a[order], n)).astype(np.int32))
            one = order[np.flatnonzero(np.diff(which, prepend=-1))]
            r, a, z, base = r[one], a[one], z[one], base[one]
            bounds = np.concatenate(([0], np.cumsum(z - a))).astype(np.int32)
            body = data[ragged(base + a, z - a)].tobytes()
            kept = batch.select(["minimizer", "region", "owner"]).take(pa.array(r))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(of[one])),
                    *kept.columns,
                    pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(ends))).astype(np.int32)), at),
                    pa.array((core_lo[one] - a).astype(np.int32)),
                    pa.array((core_hi[one] - a).astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(bounds), pa.py_buffer(body)]),
                    pa.array(signed(piece[one])),
                ],
                names=[*GROUPED, "piece"],
            )


def alike(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and the number of each row's kind in that order."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for column in columns:
        new[1:] |= column[order[1:]] != column[order[:-1]]
    return order, np.cumsum(new)


def row_key(text: str = "text") -> Column:
    return F.hash(F.coalesce(F.col(text), F.lit("")))


def repeated_strings(distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """minimizer, region and runs (first and last offset) of strings that a region with a smaller owner has too.

    A group that does not fit a block is divided by longer and longer common cores; of equal
    pieces only those of the least owner go on, so the last groups, of one string, are settled.
    """
    at = [F.array(F.lit(0)).alias("at"), F.lit(-1).alias("core_lo"), F.lit(-1).alias("core_hi")]
    rows = distinct.select(F.col("minimizer").alias("group"), "minimizer", "region", "owner", *at, "content")
    out = []
    while True:
        bounds = [F.sum(F.length("content")).alias("size"), F.min("owner").alias("least"), F.max("owner").alias("most")]
        counts = rows.groupBy(F.col("group").alias("of")).agg(*bounds).filter("least < most").select("of", "size")
        sized = scratch.save(rows.join(counts, rows.group == counts.of).select(*GROUPED, "size"), "sized")
        small = sized.filter(F.col("size") <= MOST).drop("size").repartition("group").sortWithinPartitions("group")
        out.append(scratch.save(small.mapInArrow(_blocks, RUNS_SCHEMA), "solved"))
        large = sized.filter(F.col("size") > MOST).drop("size")
        pieces = scratch.save(large.mapInArrow(_divided, f"{GROUP_SCHEMA}, piece long"), "pieces")
        scratch.drop(sized)
        if pieces.isEmpty():
            break
        least = pieces.groupBy(F.col("group").alias("g"), F.col("piece").alias("p")).agg(F.min("owner").alias("least"))
        met = pieces.join(least, (F.col("group") == F.col("g")) & (F.col("piece") == F.col("p"))).drop("g", "p", "piece")
        met = scratch.save(met, "met")
        run = F.transform("at", lambda at: F.struct(at.alias("at"), (at + F.length("content") - WINDOW).alias("upto")))
        out.append(met.filter("owner > least").select("minimizer", "region", run.alias("run")))
        rows = met.filter("owner = least").drop("least")
    return reduce(DataFrame.unionByName, out)


def removed_spans(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, row_key and the sorted ``spans`` (lo, hi) of the repeated strings' first bytes."""
    rows = docs.select("doc_id", row_key().alias("row_key"), "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    seen = rows.select("doc_id", "text").mapInArrow(_seen, "minimizer long, doc_id long, region long")
    shared = (
        seen.groupBy(F.col("minimizer").alias("of"))
        .agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min("region").alias("a"), F.max("region").alias("b"))
        .filter("source < last")
        .select("of", "source", (F.col("a") != F.col("b")).alias("branching"))
    )
    shared = scratch.save(shared, "shared")
    places = rows.mapInArrow(_places, "doc_id long, row_key int, minimizer long, lo int, hi int")
    met = scratch.save(places.join(shared, places.minimizer == shared.of).drop("of"), "met")
    scratch.drop(shared)
    keep = ["doc_id", "row_key", "lo", "hi"]
    whole = met.filter("NOT branching AND doc_id > source").select(*keep)

    unsure = met.filter("branching").groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("minimizer", "lo", "hi")).alias("spans"))
    texts = rows.join(unsure, ["doc_id", "row_key"]).select("doc_id", "row_key", "text", "spans")
    regions = scratch.save(texts.mapInArrow(_regions, REGIONS), "regions")
    distinct = regions.groupBy("minimizer", "region").agg(F.min("doc_id").alias("owner"), F.first("content").alias("content"))
    distinct = scratch.save(distinct, "distinct")
    solved = repeated_strings(distinct, scratch)
    runs = solved.groupBy(F.col("minimizer").alias("m"), F.col("region").alias("r")).agg(F.array_distinct(F.flatten(F.collect_list("run"))).alias("run"))
    owners = distinct.select(F.col("minimizer").alias("m"), F.col("region").alias("r"), "owner")
    owned = regions.drop("content").join(owners, (F.col("minimizer") == F.col("m")) & (F.col("region") == F.col("r"))).drop("m", "r")
    owned = scratch.save(owned, "owned")
    copies = owned.filter("doc_id > owner").select(*keep)
    first = owned.filter("doc_id = owner").join(runs, (F.col("minimizer") == F.col("m")) & (F.col("region") == F.col("r")))
    first = first.withColumn("run", F.explode("run"))
    first = first.select("doc_id", "row_key", (F.col("lo") + F.col("run.at")).alias("lo"), (F.col("lo") + F.col("run.upto")).alias("hi"))
    spans = whole.unionByName(copies).unionByName(first).groupBy("doc_id", "row_key")
    spans = scratch.save(spans.agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans")
    scratch.drop(met, regions, distinct, owned)
    return spans


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, runs, digests = [], [], [], []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = text.as_buffer().to_pybytes()
            kept, n = data, 0
            if spans.is_valid:
                keep = kept_mask(len(data), spans.values, WINDOW)
                kept = np.frombuffer(data, np.uint8)[keep].tobytes()
                n = int((~keep[:1]).sum() + (keep[:-1] & ~keep[1:]).sum())
            sizes.append(len(data))
            removed.append(len(data) - len(kept))
            runs.append(n)
            digests.append(hashlib.sha256(kept).hexdigest())
        numbers = [pa.array(c, pa.int64()) for c in (sizes, removed, runs)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *numbers, pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spans = removed_spans(docs, Scratch(spark, "op5"))
    rows = docs.select(F.col("doc_id").alias("__id"), row_key().alias("__key"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(spans, F.col("__id").eqNullSafe(spans.doc_id) & (F.col("__key") == spans.row_key), "left")
    return rows.select("__id", "text", "spans").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
