"""Whitening against plain Python over exact integers."""

from __future__ import annotations

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.test_operators import SF_DIR
from tidemark.llm import whitening
from tidemark.llm.common import Scratch
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, x long, packed string, id int, j int"


def run(spark, rows, schema=SCHEMA):
    path = Scratch(spark, "fixture").path("vectors")
    spark.createDataFrame([(i, v, 0, 1, "p", 2, 3) for i, v in rows], schema).repartition(5).write.parquet(f"{path}/embeddings.parquet")
    return QUERIES["op11_whitening"](spark, path).collect()


def plain(rows):
    """Integer vectors of the kept rows, n, S, and the exact covariance of the distinct ones."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    most = Counter(len(v) for _, v in kept)
    d = max(most, key=lambda k: (most[k], k))
    kept = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in kept if len(v) == d]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    cov = [[Fraction(n * sum(x[j] * x[k] for x in fit) - sums[j] * sums[k], n * n) for k in range(d)] for j in range(d)]
    return kept, n, sums, cov


def compare(got, rows, top=16):
    kept, n, sums, cov = plain(rows)
    d = len(sums)
    exact = np.array([[float(c) for c in row] for row in cov])
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1], vectors[:, ::-1]
    width = min(top, d)
    want = Counter((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept)
    assert Counter((r.vec_id, r.deviation) for r in got) == Counter({k: v * width for k, v in want.items()})
    assert {r.n for r in got} <= {n} and {r.component for r in got} <= set(range(1, width + 1))
    by_id = {}
    for i, x in kept:
        by_id.setdefault(i, []).append(np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)]))
    signs = {}
    for r in sorted(got, key=lambda r: -abs(r.whitened or 0)):
        e, v = values[r.component - 1], vectors[:, r.component - 1]
        if e <= 1e-12 * values[0]:
            assert r.whitened is None
            continue
        assert r.explained == pytest.approx(e / np.trace(exact), rel=1e-6)
        scores = [float(x @ v / math.sqrt(e)) for x in by_id[r.vec_id]]
        sign = signs.setdefault(r.component, 1 if any(abs(s - r.whitened) < 1e-6 for s in scores) else -1)
        assert any(abs(sign * s - r.whitened) < 1e-6 for s in scores)
    errors = {r.identity_error for r in got}
    assert len(errors) <= 1 and all(e is None or e < 1e-9 for e in errors)


def test_given_vectors(spark):
    source = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in source.collect()]
    compare(QUERIES["op11_whitening"](spark, SF_DIR).collect(), rows)


def test_awkward_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) * s for s in (1, 5, 0.3, 40)]) for i in range(90)]
    rows += [(i, rows[0][1]) for i in range(100, 160)]  # a third of the rows is one vector
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, rows[3][1]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows += [(201, None), (202, []), (203, [1.0, None, 2.0, 3.0]), (204, [math.nan, 1.0, 1.0, 1.0]), (205, [math.inf, 1.0, 1.0, 1.0])]
    rows += [(206, [1.0, 2.0]), (207, [-math.inf, 0.0, 0.0, 0.0]), (208, [-0.001, 0.015625, -0.015625, 0.0])]
    compare(run(spark, rows), rows)


def test_wide_ranges_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**30, rng.gauss(0, 1), float(rng.choice([0, 2**40]))]) for i in range(70)]
    got = run(spark, rows)
    kept, n, sums, _ = plain(rows)
    for i, x in kept:
        square = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        assert {r.deviation for r in got if r.vec_id == i} == {square if square < 2**63 else None}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scratch = Scratch(spark, "wide")
    prepared = whitening.prepared(frame, "embedding", scratch, "vec_id")
    model, _ = whitening.fit(prepared, scratch)
    exact = {(r.vec_id, int(r.deviation)) for r in whitening.transform(prepared, model, "vec_id").collect()}
    doubles = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows]
    sums = [sum(c) for c in zip(*(x for _, x in doubles))]
    assert exact == {(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in doubles}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_tables_without_variance(spark, rows):
    got = run(spark, rows)
    assert len(got) == 2 * sum(v is not None for _, v in rows)
    assert all(r.whitened is None and r.identity_error is None and r.deviation == 0 and r.n == 1 for r in got)


@pytest.mark.parametrize("bits, rows", [(1, 1), (3, 64), (7, 200), (8, 65)])
def test_products_from_bit_planes(bits, rows):
    rng = np.random.default_rng(bits)
    entries = rng.integers(0, 2**bits, (rows, 5)).astype(np.uint64)
    entries[:, 2] = 0
    scatter = whitening.Scatter(5, bits)
    scatter.add(entries[: rows // 2 + 1])
    scatter.add(entries[rows // 2 + 1 :])
    plain = entries.astype(np.int64)
    want = plain.T @ plain
    for j, k, total in scatter.totals():
        assert total == (plain[:, k].sum() if j < 0 else want[j, k])
