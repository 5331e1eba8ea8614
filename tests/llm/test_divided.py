"""Regions that hold their minimizer many times."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm import reference as ref
from tests.llm.test_operators import pairs, query_rows
from tidemark.llm import repeats
from tidemark.llm.common import Rolling, byte_values, signed


def region(text: bytes) -> pa.RecordBatch:
    data = np.frombuffer(text, np.uint8)
    least = signed(repeats.seeds_of(data, Rolling(byte_values(data))))[:1]
    columns = [pa.array(least), pa.array(least), pa.array([7]), pa.array([1]), pa.array([[0]], pa.list_(pa.int32()))]
    columns += [pa.array([-1], pa.int32()), pa.array([-1], pa.int32()), pa.array([text], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=repeats.GROUPED)


def test_equal_pieces_of_a_region_are_one_row():
    unit = b"a phrase of twenty-five b"
    (left, right) = repeats._divided(iter([region(unit * 40)]))
    assert left.num_rows < 5 and right.num_rows < 5
    for part in (left, right):
        places = [[at for at in row] for row in part.column("at").to_pylist()]
        assert sum(map(len, places)) > 35 and all(len(set(x)) == len(x) for x in places)
        for at, content in zip(places, part.column("content").to_pylist()):
            assert all((unit * 40)[a : a + len(content)] == content for a in at)


def test_phrases_repeated_within_texts(spark, monkeypatch):
    rng = random.Random(5)
    unit = "a phrase of twenty-five b"
    rows = [(i, "".join(rng.choice([unit * rng.randint(1, 9), f"{rng.random()} "]) for _ in range(12))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "MOST", 200)
    assert query_rows(spark, monkeypatch, df, "op5_repeats") == Counter(ref.repeated_bytes(pairs(df)))
