"""Alignment against whole-text tokenisation and sets of byte offsets."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.test_operators import SF_DIR
from tidemark.llm import alignment
from tidemark.llm.common import Scratch
from tidemark.llm.queries import QUERIES

EXTRA = "doc_id long, text string, lang string, links string, n_a int, id int, groups int"


@pytest.fixture(scope="module")
def models():
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def whole(models, text):
    """Ids of both tokenizers over the whole text, with their bytes; None if it has no tokens."""
    if not text:
        return None
    a, b = models
    alphabet = alignment.byte_alphabet()
    left = a.encode(" " + text, add_special_tokens=False)
    right = b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in t) for t in left.tokens]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in right)]
    want = (" " + text).encode()
    return (left.ids, right, bytes_a, bytes_b) if b"".join(bytes_a) == want == b"".join(bytes_b) else None


def ends(tokens):
    total, out = 0, []
    for t in tokens:
        total += len(t)
        out.append(total)
    return out


def groups_and_links(found):
    if found is None:
        return "", []
    a, b, bytes_a, bytes_b = found
    at_a, at_b = ends(bytes_a), ends(bytes_b)
    groups, i, j = [], 0, 0
    for end in sorted(set(at_a) & set(at_b)):
        k, m = at_a.index(end, i) + 1, at_b.index(end, j) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    place = {e: i for e, i in zip(at_b, b)}
    return ";".join(groups), [(i, place[e]) for e, i in zip(at_a, a) if e in place]


def plain(models, rows):
    found = [(d, whole(models, t)) for d, t in rows]
    aligned = [(d, f, *groups_and_links(f)) for d, f in found]
    counts = Counter(link for *_, links in aligned for link in links)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return Counter(
        (
            d,
            len(f[0]) if f else 0,
            len(f[1]) if f else 0,
            text.count(";") + 1 if text else 0,
            len(links),
            sum(counts[link] == highest[link[1]] for link in links),
            sum(counts[link] for link in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )
        for d, f, text, links in aligned
    )


def run(spark, rows):
    path = Scratch(spark, "fixture").path("docs")
    spark.createDataFrame([(d, t, "en", "x", 1, 2, 3) for d, t in rows], EXTRA).repartition(4).write.parquet(f"{path}/documents.parquet")
    return Counter(tuple(r) for r in QUERIES["op12_alignment"](spark, path).collect())


def test_given_documents(spark, models):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = Counter(tuple(r) for r in QUERIES["op12_alignment"](spark, SF_DIR).collect())
    assert got == plain(models, rows)


AWKWARD = [
    "a", " ", "  ", "\n", "a  b", "  lead", " trail  ", "tab\tx\n\n y\r\n", "x▁y", "é ﬁ é", "日本語 テスト", "𐍈   z　",
    "<s> </s><unk> <0x41> <|endoftext|> x", "don't  stop'll", "\x00\x1f\x85 q", "  a  ", "12345 67", "!!!  ???", "﻿ b", "a \n b\n  c",
]


def test_awkward_texts(spark, models, monkeypatch):
    rows = [(1, None), (2, ""), (None, "two words"), (None, None), (3, "two words"), (3, "two words"), (4, "q" * 5000), (5, "word " * 20_000)]
    rows += [(10 + i, t) for i, t in enumerate(AWKWARD)] + [(99, " ".join(AWKWARD))]
    assert run(spark, rows) == plain(models, rows)


def test_empty_table(spark):
    assert run(spark, []) == Counter()


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(alignment.public_files())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z  \t\n'.,!0é日　  \x1c\x85▁") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_units_are_cut_where_no_token_crosses(models, aligner, text):
    found = whole(models, text)
    got = aligner.align([text])
    groups, links = groups_and_links(found)
    assert (got.n_a[0], got.n_b[0]) == ((len(found[0]), len(found[1])) if found else (0, 0))
    assert got.texts == [groups]
    size = len(aligner.b.as_bytes)
    assert [divmod(number, size) for number in got.links.tolist()] == links


def test_full_tables_start_anew(models):
    aligner = alignment.Aligner(alignment.public_files())
    aligner.units.most = 6
    for texts in (["one two three four five six", "six five four one", None], ["seven eight", "", "one " * 30], ["x▁", "one  two"]):
        want = [groups_and_links(whole(models, t)) for t in texts]
        got = aligner.align(texts)
        assert got.texts == [g for g, _ in want]
        assert got.n_links.tolist() == [len(links) for _, links in want]


def test_windows_of_one_hash_are_told_apart(models, monkeypatch):
    monkeypatch.setattr(alignment, "mix", lambda x: np.zeros_like(x))
    aligner = alignment.Aligner(alignment.public_files())
    monkeypatch.setattr(alignment.Rolling, "of", lambda self, starts, ends: np.zeros(len(starts), np.uint64))
    texts = ["one two three two", "antidisestablishmentarianism two  x", "one"]
    assert aligner.align(texts).texts == [groups_and_links(whole(models, t))[0] for t in texts]


def test_operator_gives_the_groups(spark, models):
    frame = spark.createDataFrame([(1, "some words"), (2, None)], "key long, body string")
    got = {r.key: r.groups for r in alignment.align(frame, alignment.public_files(), "key", "body", groups=True).collect()}
    assert got == {1: groups_and_links(whole(models, "some words"))[0], 2: ""}


def test_bound_on_pairs_holds():
    files = alignment.public_files()
    bound = alignment.pair_bound(files)
    assert 50_000 < bound < 2_000_000
