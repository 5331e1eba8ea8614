"""The streaming search against a search over the whole text, and exact round trips."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm.pieces import MARK, Encoder, StreamingViterbi, Vocabulary, encode, endings_of, load_vocabulary, public_model, unit_pattern


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(public_model())


def whole_text(vocabulary: Vocabulary, text: str) -> list[int]:
    """Textbook dynamic programme over all boundaries of marked text."""
    best: list = [(0.0, -1, ())] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            hit = vocabulary.pieces.get(text[start:end])
            if hit and (best[end] is None or best[start][0] + hit[0] > best[end][0]):
                best[end] = (best[start][0] + hit[0], start, (hit[1],))
        if text[end - 1] not in vocabulary.pieces:
            score = best[end - 1][0] + vocabulary.unknown
            if best[end] is None or score > best[end][0]:
                best[end] = (score, end - 1, tuple(vocabulary.byte_ids[b] for b in text[end - 1].encode()))
    ids, at = [], len(text)
    while at > 0:
        ids[:0] = best[at][2]
        at = best[at][1]
    return ids


def small(letters: str, seed: int) -> Vocabulary:
    rng = random.Random(seed)
    texts = {c for c in letters} | {"".join(rng.choices(letters, k=rng.randint(2, 5))) for _ in range(30)}
    pieces = {t: (-float(rng.randint(1, 40)), 256 + i) for i, t in enumerate(sorted(texts))}
    as_bytes = [bytes([i]) for i in range(256)] + [t.encode() for t in sorted(texts)]
    return Vocabulary(pieces, endings_of(pieces), list(range(256)), as_bytes, -100.0, max(map(len, texts)), unit_pattern(pieces))


@given(st.text("abcz", max_size=60), st.integers(0, 30), st.integers(1, 9))
@settings(deadline=None, max_examples=200)
def test_stream_equals_whole_text(text, seed, step):
    vocabulary = small("abc", seed)
    search = StreamingViterbi(vocabulary)
    for i in range(0, len(text), step):
        search.feed(text[i : i + step])
    assert search.finish() == whole_text(vocabulary, text)


def test_state_stays_small():
    vocabulary = small("ab", 3)
    search = StreamingViterbi(vocabulary)
    most = 0
    for _ in range(200):
        search.feed("".join(random.Random(7).choices("ab", k=50)))
        most = max(most, len(search.scores))
    assert most < 64 * vocabulary.longest
    assert len(search.ids) > 1000


@given(st.one_of(st.text(max_size=80), st.text("ab .,!(|é_1", max_size=80)))
@settings(deadline=None, max_examples=200)
def test_round_trip_and_whole_text(vocabulary, text):
    coder = Encoder(vocabulary)
    ids = coder.encode(text)
    assert coder.decode(ids) == text.encode("utf-8", "surrogatepass")
    if text and MARK not in text and not any("\ud800" <= c <= "\udfff" for c in text):
        assert list(ids) == whole_text(vocabulary, (" " + text).replace(" ", MARK))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " a  b "), (None, MARK), (3, " a  b "), (4, "x" * 20000), (5, "tab\tline\n\u0000")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS pieces")
    got = {(r.doc_id, r.n_pieces): r for r in encode(df, public_model()).collect()}
    assert got[(1, None)].pieces is None and got[(1, None)].round_trip is None
    assert got[(2, 0)].pieces == []
    assert all(r.round_trip for k, r in got.items() if k[0] != 1)
    assert encode(df.limit(0), public_model()).count() == 0
