"""SentencePiece encoding by a streaming Viterbi search, and decoding.

A text gets a leading blank and its blanks become the piece mark; the encoding is the split
into vocabulary pieces with the greatest sum of piece scores (ties: the longer last piece).
A character outside the vocabulary, the mark itself included, is written as its UTF-8 bytes
in byte pieces, at a cost below any piece, so decoding restores every text exactly.

The search goes on from the best paths to the last ``longest`` boundaries only, ``longest``
being the length of the longest piece; no later piece can start before them. Whenever a few
windows of boundaries have gathered, the surviving paths are followed back to the boundary
that they all go through, and the ids before it are committed and forgotten. The state
therefore stays small in texts of any length.

No piece of such a vocabulary holds a mark after another character (checked when it is
loaded), so all paths converge before each run of blanks; likewise they converge between a
letter and a punctuation mark that no piece holds behind a letter. A unit - the characters
from one such boundary to the next - is searched once and remembered by the worker in two bounded
tables: when the newer is full, it replaces the older, and what is used moves on.

The vocabulary is read on the driver from ``model_file`` and broadcast; its size is that of
the model. Edge cases: a null text gives null ids and null round_trip, an empty one no ids;
repeated rows encode alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import remembered

MARK = "▁"
PUNCTUATION = ".,;:!?|*$%&#()[]\"'"
LETTER = r"[^\W\d_]"
REMEMBERED = 600_000
# Scores below this mark pieces that a model keeps out of its ordinary segmentations.
OUTLIER = -1e8
SLICE = 1 << 21


@dataclass(frozen=True)
class Vocabulary:
    pieces: dict[str, tuple[float, int]]  # text of a piece: score, id
    endings: dict[str, tuple[float, int]]  # every ending of a piece: its score and id, or id -1
    byte_ids: list[int]  # id of each byte's piece
    as_bytes: list[bytes]  # what each id decodes to
    unknown: float  # score of a character outside the vocabulary
    longest: int
    unit: str  # pattern of the units between boundaries that all paths go through


def endings_of(pieces: dict[str, tuple[float, int]]) -> dict[str, tuple[float, int]]:
    """Lets a search from the end of a piece stop where no piece goes on."""
    return {p[i:]: (0.0, -1) for p in pieces for i in range(1, len(p))} | pieces


def unit_pattern(pieces: dict[str, tuple[float, int]]) -> str:
    letter = re.compile(LETTER)
    behind = {b for p in pieces for a, b in zip(p, p[1:]) if b in PUNCTUATION and letter.match(a)}
    closing = re.escape("".join(c for c in PUNCTUATION if c not in behind))
    whole = r" *[^ ]+| +"
    return rf" *[^ {closing}]*{LETTER}(?=[{closing}])|{whole}" if closing else whole


def load_vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, byte_ids, as_bytes = {}, [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            as_bytes.append(bytes([int(piece[1:-1], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            as_bytes.append(b"")
        else:
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses a blank")
            pieces[piece] = (model.get_score(i), i)
            as_bytes.append(piece.replace(MARK, " ").encode())
    if -1 in byte_ids:
        raise ValueError("the vocabulary has no piece for some byte")
    worst = min((s for s, _ in pieces.values() if s > OUTLIER), default=0.0)
    return Vocabulary(pieces, endings_of(pieces), byte_ids, as_bytes, worst - 10.0, max(map(len, pieces), default=1), unit_pattern(pieces))


class StreamingViterbi:
    """Best split of a stream of characters; ids come out as soon as they are certain.

    The lists hold, for each boundary since the last committed one, the best score, the
    boundary before it on the best path, and the ids of that step.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.tail = ""  # the last characters, at most ``longest``
        self.scores, self.parents, self.steps = [0.0], [-1], [()]
        self.ids: list[int] = []
        self.due = 4 * vocabulary.longest

    def feed(self, text: str) -> None:
        words, scores, parents, steps = self.vocabulary, self.scores, self.parents, self.steps
        find, longest = words.endings.get, words.longest
        text = self.tail + text
        for end in range(len(self.tail) + 1, len(text) + 1):
            n = len(scores)
            best, parent, ids = float("-inf"), n - 1, ()
            for width in range(1, min(longest, n, end) + 1):
                hit = find(text[end - width : end])
                if hit is None:
                    break
                if hit[1] >= 0 and (score := scores[-width] + hit[0]) >= best:
                    best, parent, ids = score, n - width, (hit[1],)
            if (char := text[end - 1]) not in words.pieces and (score := scores[-1] + words.unknown) > best:
                best, parent = score, n - 1
                ids = tuple(words.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))
            scores.append(best)
            parents.append(parent)
            steps.append(ids)
            if n >= self.due:
                self.commit()
        self.tail = text[-longest:]

    def commit(self) -> None:
        """Give out the ids before the last boundary that all surviving paths go through."""
        parents = self.parents
        paths = set(range(max(0, len(parents) - self.vocabulary.longest), len(parents)))
        while len(paths) > 1:
            last = max(paths)
            paths.remove(last)
            paths.add(parents[last])
        root = paths.pop()
        self.ids.extend(self.ids_to(root))
        del self.scores[:root], self.parents[:root], self.steps[:root]
        self.parents[:] = [p - root for p in self.parents]
        self.due = len(self.parents) + 4 * self.vocabulary.longest

    def ids_to(self, boundary: int) -> list[int]:
        path = []
        while boundary > 0:
            path.append(self.steps[boundary])
            boundary = self.parents[boundary]
        return list(chain.from_iterable(reversed(path)))

    def finish(self) -> list[int]:
        """All ids; the best path to the end is the only one left."""
        return self.ids + self.ids_to(len(self.parents) - 1)


class Encoder(dict):
    """Ids by unit; a unit that is met for the first time is searched."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, tuple[int, ...]] = {}
        self.units = re.compile(vocabulary.unit).findall

    def __missing__(self, unit: str) -> tuple[int, ...]:
        ids = self.older.get(unit)
        if ids is None:
            ids = self.search(unit)
        if len(unit) <= 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[unit] = ids
        return ids

    def search(self, unit: str) -> tuple[int, ...]:
        search = StreamingViterbi(self.vocabulary)
        blanks = len(unit) - len(unit.lstrip(" "))
        # A mark that stands in the text itself is not a blank: it goes to its bytes.
        for i, part in enumerate(unit[blanks:].split(MARK)):
            if i:
                search = self._bytes(search, MARK)
            search.feed(MARK * blanks + part if i == 0 else part)
        return tuple(search.finish())

    def _bytes(self, search: StreamingViterbi, char: str) -> StreamingViterbi:
        """Close a search and start the next one behind a character written as bytes."""
        done = [*search.finish(), *(self.vocabulary.byte_ids[b] for b in char.encode())]
        again = StreamingViterbi(self.vocabulary)
        again.ids = done
        return again

    def encode(self, text: str) -> array:
        return array("i", chain.from_iterable(map(self.__getitem__, self.units(" " + text)))) if text else array("i")

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.vocabulary.as_bytes.__getitem__, ids))[1:]


ENCODED = "doc_id long, n_pieces long, pieces array<int>, round_trip boolean"


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_pieces, pieces and round_trip (decoding gives the text again) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(load_vocabulary(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(shared.value)
        for batch in batches:
            lo = 0
            while lo < batch.num_rows:
                ids, values, counts, exact, size, hi = [], array("i"), [], [], 0, lo
                while hi < batch.num_rows and size < SLICE:
                    text = batch.column(1)[hi].as_py()
                    if text is None:
                        counts.append(None)
                        exact.append(None)
                    else:
                        found = coder.encode(text)
                        values.extend(found)
                        counts.append(len(found))
                        exact.append(coder.decode(found) == text.encode("utf-8", "surrogatepass"))
                        size += len(text)
                    hi += 1
                yield record_batch(batch.column(0).slice(lo, hi - lo), counts, values, exact)
                lo = hi

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def encoder_of(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process and vocabulary, so that tasks share what is remembered."""
    key = hash((len(vocabulary.pieces), tuple(vocabulary.as_bytes)))
    return remembered(("pieces", key), lambda: Encoder(vocabulary))


def record_batch(doc_ids: pa.Array, counts: list[int | None], values: array, exact: list[bool | None]) -> pa.RecordBatch:
    ends = [0]
    for n in counts:
        ends.append(ends[-1] + (n or 0))
    n_pieces = pa.array(counts, pa.int64())
    flat = pa.Array.from_buffers(pa.int32(), len(values), [None, pa.py_buffer(values)])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=n_pieces.is_null())
    return pa.RecordBatch.from_arrays(
        [doc_ids, n_pieces, lists, pa.array(exact, pa.bool_())], names=["doc_id", "n_pieces", "pieces", "round_trip"]
    )


def public_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_model())
