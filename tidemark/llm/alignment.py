"""Alignment of two tokenizers' tokens on the bytes of a text.

Every text is tokenised whole by both. Both split a text only into tokens that join to the
text with a blank before it, so tokens are compared by the byte offsets where they end. Where
tokens of both end together a group of tokens ends; such an end is a link between the two
tokens.

*Anchors* are shared ends, verified on the byte offsets, before a token that starts with a
blank on both sides, and the ends of texts. They cut a text into windows, mostly single words.
How the tokens of a window group depends on its token ids alone, so it is worked out once for
each pair of id tuples in a slice of texts, and looked up for the other windows of that pair.

Tokenising is remembered as well, per unit: the characters from one place that no token of
either tokenizer crosses to the next. Such places are before a blank or a line feed behind a
character that is no white space, and between a Latin letter and a closing mark: the byte-level
tokenizer's pattern ends a match there, and no piece of the other goes across (checked when
it is loaded). So the tokens of the units, one after the other, are those of the whole text.

How often an id pair is linked is summed over the corpus in Spark, combined in the map tasks,
so a text with a third of all copies sends each of its pairs once per task. Of two tokens that
end together the shorter is an ending of the longer; the number of pairs is therefore bounded
by the endings of the two vocabularies, whatever the corpus, and that table alone is broadcast
(its size is checked against the bound). Both vocabularies are bounded by their files, which
are read on the driver and shared with the tasks.

Edge cases: a text that is null, empty or not restored byte by byte by both tokenizers (as one
that holds the mark U+2581) has no tokens, no groups and an empty digest; repeated rows align
alike and count each; null ids stay; memory grows with the longest text, not with the table;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import Rolling, Scratch, mix, ragged, remembered

MARK = "▁"
# Unicode's white space, and letters and marks between which texts may be cut.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
CLOSING = ".,;:!?|*$%&#()[]\"'"
REMEMBERED = 400_000  # units per worker
SLICE = 1 << 20  # bytes of text, or links, that are worked on at once, or one longer row


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write the 256 bytes.

    Bytes that are printable stand for themselves; the others take the code points from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Files:
    """Contents of the two vocabulary files."""

    byte_level: bytes  # a byte-level BPE in the JSON form of ``tokenizers``
    pieces: bytes  # a ``sentencepiece`` model

    @staticmethod
    def read(byte_level: str, pieces: str) -> Files:
        with open(byte_level, "rb") as a, open(pieces, "rb") as b:
            return Files(a.read(), b.read())


class Tokens:
    """One tokenizer: ids of units, and of each id its bytes."""

    def __init__(self, as_bytes: list[bytes]):
        self.as_bytes = as_bytes
        self.lengths = np.array([len(b) for b in as_bytes], np.int64)
        self.blank = np.array([b[:1] == b" " for b in as_bytes])

    def encode(self, units: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def restored(self, units: list[str], flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether each unit's ids join to its bytes again; the ids lie one after the other."""
        want = [u.encode() for u in units]
        names = list(map(self.as_bytes.__getitem__, flat.tolist()))
        lengths = np.fromiter(map(len, want), np.int64, len(want))
        ends = np.append(0, self.lengths[flat].cumsum())[sizes.cumsum()]
        if np.array_equal(ends, lengths.cumsum()) and b"".join(names) == b"".join(want):
            return np.ones(len(units), np.int8)
        stops = sizes.cumsum().tolist()
        return np.array([b"".join(names[lo:hi]) == w for lo, hi, w in zip([0, *stops], stops, want)], np.int8)


def unit_pattern(pieces: list[str]) -> re.Pattern[str]:
    """Units between places that no token of either tokenizer crosses.

    A unit ends before a blank or a line feed that follows a character that is no white space,
    and before a closing mark that no piece holds behind a letter.
    """
    behind = {b for p in pieces for a, b in zip(p, p[1:]) if re.match(f"[{LETTERS}]", a)}
    for p in pieces:
        if MARK in p.lstrip(MARK) or "\n" in p[1:] or MARK in p and "\n" in p:
            raise ValueError(f"piece {p!r} crosses a blank or a line feed")
    closing = re.escape("".join(c for c in CLOSING if c not in behind))
    going_on = WHITE.replace("\t-\r ", "\t\x0b-\r")  # white space but for blank and line feed
    more = rf"(?:[{going_on}][{WHITE}]*+[^{WHITE}]*+)*+"
    rest = rf"(?:[{WHITE}]++[^{WHITE}]*+|[^{WHITE}]++){more}"
    if not closing:
        return re.compile(rest)
    word = rf"[{WHITE}]*+[^{WHITE}{closing}]++"
    return re.compile(rf"{word}(?:(?<=[{LETTERS}])(?=[{closing}])|[^{WHITE}]*+{more})|{rest}")


class ByteLevel(Tokens):
    def __init__(self, content: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(content.decode())
        self.model.encode_special_tokens = True
        alphabet = byte_alphabet()
        pieces = [self.model.id_to_token(i) or "" for i in range(self.model.get_vocab_size())]
        super().__init__([bytes(alphabet[c] for c in p) if all(c in alphabet for c in p) else p.encode() for p in pieces])

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(units, add_special_tokens=False)]


class Pieces(Tokens):
    """The model puts a blank before a text itself, but none before an empty one.

    A unit without a blank in front is encoded behind a letter, which no piece of it joins.
    """

    def __init__(self, content: bytes):
        import sentencepiece

        model = self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        as_bytes, plain = [], []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                as_bytes.append(b"")
            elif model.is_byte(i):
                as_bytes.append(bytes([int(piece[1:-1], 16)]))
            else:
                as_bytes.append(piece.replace(MARK, " ").encode())
                plain.append(piece)
        self.lone, self.letter = [model.piece_to_id(MARK)], len(model.encode("a"))
        self.unit = unit_pattern(plain)
        super().__init__(as_bytes)

    def encode(self, units: list[str]) -> list[list[int]]:
        found = self.model.encode([u[1:] if u[0] == " " else "a" + u for u in units], num_threads=1)
        return [(ids if len(u) > 1 else self.lone) if u[0] == " " else ids[self.letter :] for u, ids in zip(units, found)]


class Lists:
    """Lists of numbers, one after the other, that are read by their indices."""

    def __init__(self):
        self.flat, self.ends = array("q"), array("q", [0])

    def __len__(self) -> int:
        return len(self.ends) - 1

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Add lists that lie one after the other in ``values``."""
        self.ends.frombytes((len(self.flat) + np.cumsum(lengths, dtype=np.int64)).tobytes())
        self.flat.frombytes(np.ascontiguousarray(values, np.int64).tobytes())

    def of(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of the given indices joined, and the length of each."""
        flat, ends = np.frombuffer(self.flat, np.int64), np.frombuffer(self.ends, np.int64)
        lengths = ends[index + 1] - ends[index]
        return flat[ragged(ends[index], lengths)], lengths


def looked_up(known: dict, new: list, distinct: dict, keys: list) -> np.ndarray:
    """The numbers of the keys after ``new`` are numbered; the large table is asked once for each."""
    known.update(zip(new, range(len(known), len(known) + len(new))))
    near = dict(zip(distinct, map(known.__getitem__, distinct)))
    return np.fromiter(map(near.__getitem__, keys), np.int64, len(keys))


class Units:
    """Number by unit, with both tokenizers' ids of it; starts anew when it is full."""

    def __init__(self, a: ByteLevel, b: Pieces, most: int = REMEMBERED):
        self.a, self.b, self.most = a, b, most
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.left, self.right, self.whole = Lists(), Lists(), array("b")

    def numbers(self, units: list[str]) -> np.ndarray:
        distinct = dict.fromkeys(units)
        new = [u for u in distinct if u not in self.known]
        if len(self.known) + len(new) > self.most or len(self.left.flat) > 16 * self.most:
            self.forget()
            new = list(distinct)
        if new:
            whole = np.ones(len(new), np.int8)
            for model, lists in ((self.a, self.left), (self.b, self.right)):
                ids = model.encode(new)
                flat, sizes = np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))
                lists.extend(flat, sizes)
                whole &= model.restored(new, flat, sizes)
            self.whole.frombytes(whole.tobytes())
        return looked_up(self.known, new, distinct, units)

    def are_whole(self, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.whole, np.int8)[numbers] == 1


class Windows:
    """Groups and links of windows, which are given by the ids of their tokens."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a, self.b = a.lengths, b.lengths
        # How an id is written within a group and at the end of its side, for A and for B.
        self.written = [f"{i}{end}" for n, ends in ((len(self.a), ",|"), (len(self.b), ",;")) for end in ends for i in range(n)]

    def work_out(
        self, left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray
    ) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Per window its groups as text and its number of links, and all links.

        The ids of all windows lie one after the other; a group ends where both sides' bytes end.
        """
        ends_a, ends_b, shared_a, shared_b = shared_ends(self.a[left], self.b[right])
        last_a, last_b = n_left.cumsum() - 1, n_right.cumsum() - 1
        if not np.array_equal(ends_a[last_a], ends_b[last_b]):
            raise AssertionError("the sides of a window end apart")
        # Tokens in the order of the text: of each group those of A, then those of B.
        closes_a, closes_b = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        closes_a[shared_a] = closes_b[shared_b] = 1
        group_a, group_b = closes_a.cumsum() - closes_a, closes_b.cumsum() - closes_b
        before_b, upto_a = np.append(0, shared_b + 1), shared_a + 1
        order = np.empty(len(left) + len(right), np.int64)
        order[np.arange(len(left)) + before_b[group_a]] = left + closes_a * len(self.a)
        order[np.arange(len(right)) + upto_a[group_b]] = right + closes_b * len(self.b) + 2 * len(self.a)
        words = list(map(self.written.__getitem__, order.tolist()))
        stops = (n_left + n_right).cumsum().tolist()
        texts = ["".join(words[lo:hi])[:-1] for lo, hi in zip([0, *stops], stops)]
        n_links = np.diff(np.searchsorted(shared_a, last_a, "right"), prepend=0)
        return texts, n_links, left[shared_a] * len(self.b) + right[shared_b]


def shared_ends(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte ends of both sides' tokens, and on each side the tokens whose ends the other has."""
    ends_a, ends_b = sizes_a.cumsum(), sizes_b.cumsum()
    if ends_a[-1] != ends_b[-1]:
        raise AssertionError("the tokenizers cover different bytes")
    at = np.zeros(ends_a[-1] + 1, np.uint8)
    at[ends_a] = 1
    at[ends_b] += 2
    return ends_a, ends_b, np.flatnonzero(at[ends_a] == 3), np.flatnonzero(at[ends_b] == 3)


@dataclass(frozen=True)
class Aligned:
    """Of a run of texts: numbers of tokens, groups as text, and links as pair numbers."""

    n_a: np.ndarray
    n_b: np.ndarray
    texts: list[str]
    links: np.ndarray
    n_links: np.ndarray


def per_text(owners: np.ndarray, amounts: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owners, amounts, n).astype(np.int64)


class Aligner:
    """Groups and links of texts; remembers units."""

    def __init__(self, files: Files):
        self.a, self.b = ByteLevel(files.byte_level), Pieces(files.pieces)
        self.units, self.windows = Units(self.a, self.b), Windows(self.a, self.b)

    def align(self, texts: list[str | None]) -> Aligned:
        found = [self.b.unit.findall(" " + t) if t else [] for t in texts]
        n = len(texts)
        owners = np.repeat(np.arange(n), [len(f) for f in found])
        numbers = self.units.numbers(list(chain.from_iterable(found)))
        # Texts that are not restored have no tokens.
        lost = np.zeros(n, bool)
        lost[owners[~self.units.are_whole(numbers)]] = True
        numbers, owners = numbers[~lost[owners]], owners[~lost[owners]]
        if not len(numbers):
            nothing = np.zeros(n, np.int64)
            return Aligned(nothing, nothing, [""] * n, np.zeros(0, np.int64), nothing)
        left, sizes_a = self.units.left.of(numbers)
        right, sizes_b = self.units.right.of(numbers)
        cuts_a, cuts_b = self.anchors(left, right)
        which, asked = distinct_windows(left, right, cuts_a, cuts_b)
        spans = [(ids, cuts[:-1][asked], np.diff(cuts)[asked]) for ids, cuts in ((left, cuts_a), (right, cuts_b))]
        written, sizes, numbers = self.windows.work_out(*chain.from_iterable((ids[ragged(at, n)], n) for ids, at, n in spans))
        # The text of a window is that of its first token of A.
        owner = np.repeat(owners, sizes_a)[cuts_a[:-1]]
        n_links = sizes[which]
        links = numbers[ragged((sizes.cumsum() - sizes)[which], n_links)]
        bounds = np.searchsorted(owner, np.arange(n + 1)).tolist()
        groups = list(map(written.__getitem__, which.tolist()))
        joined = [";".join(groups[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
        return Aligned(per_text(owners, sizes_a, n), per_text(owners, sizes_b, n), joined, links, per_text(owner, n_links, n))

    def anchors(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers on both sides where windows start, and the end."""
        _, _, shared_a, shared_b = shared_ends(self.a.lengths[left], self.b.lengths[right])
        # Behind the last token of a text stands the next text, whose tokens start with a blank.
        blank_a, blank_b = np.append(self.a.blank[left[1:]], True), np.append(self.b.blank[right[1:]], True)
        anchored = blank_a[shared_a] & blank_b[shared_b]
        return np.append(0, shared_a[anchored] + 1), np.append(0, shared_b[anchored] + 1)


def distinct_windows(left: np.ndarray, right: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window its number among the different ones, and where those stand first.

    Windows are sorted out by hashes and then compared id by id with the first of their hash;
    one that differs counts as different from all.
    """
    hashes = mix(Rolling(mix(left.view(np.uint64))).of(cuts_a[:-1], cuts_a[1:]) + np.uint64(1))
    hashes ^= Rolling(mix(right.view(np.uint64))).of(cuts_b[:-1], cuts_b[1:])
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    odd = differing(left, cuts_a, first[which]) | differing(right, cuts_b, first[which])
    which[odd] = len(first) + np.arange(int(odd.sum()))
    return which, np.concatenate((first, np.flatnonzero(odd)))


def differing(ids: np.ndarray, cuts: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each window differs from the window of number ``other``."""
    sizes = np.diff(cuts)
    odd = sizes != sizes[other]
    usable = np.where(odd, 0, sizes)
    mine, others = ids[ragged(cuts[:-1], usable)], ids[ragged(cuts[:-1][other], usable)]
    odd[np.repeat(np.arange(len(sizes)), usable)[mine != others]] = True
    return odd


def pair_bound(files: Files) -> int:
    """Most id pairs that can end together: endings of each token that are tokens of the other."""
    a, b = ByteLevel(files.byte_level).as_bytes, Pieces(files.pieces).as_bytes
    return sum(_endings(longer, shorter, own) for longer, shorter, own in ((a, b, True), (b, a, False)))


def _endings(tokens: list[bytes], others: list[bytes], own: bool) -> int:
    """Pairs of a token and an ending of it among the others; whole tokens count only if ``own``."""
    ids: dict[bytes, int] = {}
    for other in others:
        if other:
            ids[other] = ids.get(other, 0) + 1
    return sum(ids.get(t[i:], 0) for t in tokens for i in range(0 if own else 1, len(t)))


ALIGNED = "n_a long, n_b long, n_groups long, groups_sha256 string, links array<long>"

def aligner_of(files: Files) -> Aligner:
    """One aligner per worker process and pair of files, so that tasks share what is remembered."""
    key = hash((files.byte_level, files.pieces))
    return remembered(("alignment", key), lambda: Aligner(files))


def runs(sizes) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum up to ``SLICE`` at most, or one larger row."""
    lo = total = 0
    for hi, size in enumerate(sizes):
        if hi > lo and total + size > SLICE:
            yield lo, hi
            lo, total = hi, 0
        total += size
    if lo < len(sizes):
        yield lo, len(sizes)


def align(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """Per row: the id, numbers of tokens and groups, the groups' digest, and the links.

    ``groups`` adds the groups as text. A link is a number ``a * size of vocabulary B + b``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(shared.value)
        for batch in batches:
            for lo, hi in runs(pc.binary_length(batch.column(1)).fill_null(0).to_pylist()):
                part = batch.slice(lo, hi - lo)
                found = aligner.align(part.column(1).to_pylist())
                ends = np.append(0, found.n_links.cumsum()).astype(np.int32)
                columns = [
                    part.column(0),
                    pa.array(found.n_a),
                    pa.array(found.n_b),
                    pa.array(found.n_links),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in found.texts], pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(found.links)),
                ]
                names = ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
                if groups:
                    columns.append(pa.array(found.texts, pa.string()))
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, {ALIGNED}" + (", groups string" if groups else "")
    rows = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)
    return rows.withColumnRenamed("id", id_col)


def counted(values: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers with the sums of their counts."""
    numbers, at = np.unique(np.concatenate([v for v, _ in values]), return_inverse=True)
    return numbers, np.bincount(at, np.concatenate([c for _, c in values]), len(numbers)).astype(np.int64)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count): links per id pair over all rows, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for lo, hi in runs(np.diff(batch.column(0).offsets.to_numpy())):
                held.append(np.unique(batch.column(0).slice(lo, hi - lo).flatten().to_numpy(), return_counts=True))
                if sum(len(v) for v, _ in held) > 4 * len(held[0][0]) + SLICE:
                    held = [counted(held)]
        if held:
            numbers, counts = counted(held)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(counts)], names=["pair", "count"])

    parts = aligned.select("links").mapInArrow(run, "pair long, count long")
    return parts.groupBy("pair").agg(F.sum("count").alias("count"))


@dataclass(frozen=True)
class PairTable:
    """Numbers of all id pairs, rising, with their counts and whether the B id has no higher one."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray


def pair_table(aligned: DataFrame, files: Files, n_b: int, scratch: Scratch) -> PairTable:
    """The corpus-wide table; its size is bounded by the vocabularies and checked."""
    highest = Window.partitionBy(F.col("pair") % n_b)
    counts = scratch.save(pair_counts(aligned), "pairs")
    if counts.count() > pair_bound(files):
        raise AssertionError("more id pairs than the vocabularies allow")
    table = counts.select("pair", "count", (F.col("count") == F.max("count").over(highest)).alias("best")).toArrow().sort_by("pair")
    column = lambda name: table.column(name).combine_chunks().to_numpy(zero_copy_only=False)
    return PairTable(column("pair"), column("count"), column("best"))


def scored(aligned: DataFrame, table: PairTable) -> DataFrame:
    """The aligned rows with n_links, n_best and count_sum in place of the links."""
    shared = aligned.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in aligned.columns if c != "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for lo, hi in runs(np.diff(batch.column(len(kept)).offsets.to_numpy())):
                part = batch.slice(lo, hi - lo)
                links = part.column(len(kept))
                sizes = np.diff(links.offsets.to_numpy()).astype(np.int64)
                distinct, at = np.unique(links.flatten().to_numpy(), return_inverse=True)
                place = np.searchsorted(known.pairs, distinct)
                rows = np.repeat(np.arange(len(sizes)), sizes)
                sums = np.zeros(len(sizes), np.int64)
                np.add.at(sums, rows, known.counts[place][at])
                added = [pa.array(sizes), pa.array(per_text(rows, known.best[place][at], len(sizes))), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(part.columns[: len(kept)] + added, names=[*kept, "n_links", "n_best", "count_sum"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields if f.name != "links"]
    return aligned.select(*kept, "links").mapInArrow(run, ", ".join([*fields, "n_links long, n_best long, count_sum long"]))


def public_files() -> Files:
    import public_tokenizers

    return Files.read(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, scratch = public_files(), Scratch(spark, "op12")
    aligned = scratch.save(align(spark.read.parquet(f"{sf_dir}/documents.parquet"), files), "aligned")
    n_b = len(Pieces(files.pieces).as_bytes)
    rows = scored(aligned, pair_table(aligned, files, n_b, scratch))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
