"""The pipeline, stage by stage, against plain Python over what each stage was given."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import reference as ref
from tests.llm.test_operators import SF_DIR, plain_targets
from tidemark.llm.common import Scratch
from tidemark.llm.langid import Classifier, fit
from tidemark.llm.pieces import Encoder, load_vocabulary, public_model


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the result of every stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    scratch, out = Scratch(spark, "stages"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.save(stage(spark, docs, SF_DIR), name)
        out.append(docs)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay_but_for_the_last(stages):
    assert [s.columns for s in stages[1:-1]] == [stages[0].columns] * 4
    assert stages[-1].columns == ["doc_id", "n_pieces", "pieces", "round_trip"]


def test_language_stage(stages):
    judge = Classifier(fit(stages[0]))
    want = Counter((d, t) for d, t in texts(stages[0]) if not judge(t)[2])
    assert Counter(texts(stages[1])) == want
    assert len(want) > 0.97 * stages[0].count()


def test_near_duplicate_stage(stages):
    rows = texts(stages[1])
    want = Counter(row for row, (d, _, c) in zip(rows, ref.near_duplicate_groups(rows)) if c == d)
    assert Counter(texts(stages[2])) == want


def test_passage_stage(stages):
    want = Counter((d, h) for d, _, _, h in ref.repeated_words(texts(stages[2])))
    assert Counter((d, ref.sha(" ".join(ref.words(t)).encode())) for d, t in texts(stages[3])) == want
    assert stages[3].filter(F.col("n_chars") != F.length("text")).isEmpty()


def test_mixing_stage(stages):
    sizes = Counter()
    for r in stages[3].select("text", "source").collect():
        sizes[r.source] += len(ref.words(r.text))
    taken = Counter()
    for r in stages[4].select("text", "source").collect():
        taken[r.source] += len(ref.words(r.text))
    want = plain_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 0.3 * want[s] for s in want)
    copies = Counter(d for d, _ in texts(stages[4]))
    assert max(copies.values()) <= 3
    assert set(copies) <= {d for d, _ in texts(stages[3])}


def test_piece_stage(stages):
    coder = Encoder(load_vocabulary(public_model()))
    want = Counter((d, tuple(coder.encode(t))) for d, t in texts(stages[4]))
    assert Counter((r.doc_id, tuple(r.pieces)) for r in stages[5].collect()) == want
    assert stages[5].filter("NOT round_trip").isEmpty()


def test_run_gives_the_last_stage(spark, stages):
    assert Counter(map(str, corpus_pipeline.run(spark, SF_DIR).collect())) == Counter(map(str, stages[-1].collect()))
