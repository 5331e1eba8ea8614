"""Narrow margins of the language models are rejected."""

from __future__ import annotations

import random

import pytest

from tidemark.llm import langid


def noise(n_words: int, n: int = 60) -> list[str]:
    rng = random.Random(n_words)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return [" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n_words)) for _ in range(n)]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_text_in_no_language_goes_and_clean_documents_stay(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    models = langid.fit(docs)
    judge = langid.Classifier(models)
    assert langid.NARROW <= models.narrow < 0.1
    for n_words in (200, 1000):
        assert all(judge(t)[2] for t in noise(n_words))
    rows = langid.predict(docs.select("doc_id", "text"), models)
    # Ties of a few letters apart, which no margin can tell.
    assert rows.filter("__language.rejected AND length(text) > 20").count() < 0.005 * docs.count()
    assert rows.filter("__language.rejected != (__language.score <= %r)" % models.narrow).isEmpty()


def test_without_documents_beyond_the_sample_the_least_margin_counts(spark):
    rows = [(1, "the of and", "en"), (2, "le la les des", "fr")]
    models = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.narrow == langid.NARROW > 0
    assert not langid.Classifier(models)("le la les des")[2]
