"""Stages on rows with nulls, empty and repeated texts, and columns of awkward names."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tidemark.llm import langid, mixing, parity, paths
from tidemark.llm.common import Scratch

AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, __copy int, __gone int, __key int, __Language string, row int, label int, rate double"
MORE = ("dot", 1, 2, 3, "l", 4, 5, 0.5)


@pytest.fixture(scope="module")
def docs(spark):
    words = " ".join(f"word{i}" for i in range(120))
    rows = [(1, words, "en", "s"), (2, words, "en", "s"), (3, None, None, None), (4, "", "en", "t"), (None, words, "en", "s")]
    rows += [(5, "x " + words, "en", None), (5, "x " + words, "en", None), (6, "!!!", None, "t")]
    return spark.createDataFrame([(d, t, lang, s, 9, *MORE) for d, t, lang, s in rows], AWKWARD).repartition(3)


def checked(got, docs, n=None):
    assert got.columns == docs.columns
    rows = got.collect()
    assert all(tuple(r)[5:] == MORE for r in rows) and (n is None or len(rows) == n)
    return rows


def test_near_copies(spark, docs):
    kept = checked(parity.first_of_each(docs, Scratch(spark, "first"), 5, 80), docs)
    assert {r.doc_id for r in kept} == {1, 3, 4, 6, None}


def test_passages(spark, docs):
    cut = checked(paths.cut(docs, Scratch(spark, "cut")), docs, 8)
    assert {r.doc_id: len((r.text or "").split()) for r in cut if r.doc_id} == {1: 120, 2: 0, 3: 0, 4: 0, 5: 1, 6: 1}


def test_mix(spark, docs):
    checked(mixing.mix(docs, Scratch(spark, "mix")), docs)


def test_language(spark, docs):
    checked(corpus_pipeline.language_id(spark, docs, ""), docs)
    with pytest.raises(ValueError, match="__language"):
        langid.predict(docs, {})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_tables(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), "").count() == 0
