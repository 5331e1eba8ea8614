"""Values carried over range partitions, and the as-of join on them."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import Row, functions as F

from tidemark.operators.as_of import as_of_join
from tidemark.operators.carry import PART, carry, laid_out


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_carried_values(spark, tmp_path, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), i, rng.choice([None, i * 10])) for i in range(150)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, at int, v int")
    placed = laid_out(df, ["k"], ["at"], str(tmp_path / "placed"), partitions)
    got = carry(placed, ["k"], ["at"], {"p": F.col("v"), "p_at": F.col("at")}, {"f": F.col("v"), "f_at": F.col("at")}, {"l": F.col("v")}, "n")
    keys = defaultdict(list)
    for k, at, v in sorted(rows, key=lambda r: r[1]):
        keys[k].append((at, v))
    want = set()
    for k, known in keys.items():
        last = None
        for i, (at, v) in enumerate(known):
            last = v if v is not None else last
            p_at, p = known[i - 1] if i else (None, None)
            f_at, f = known[i + 1] if i + 1 < len(known) else (None, None)
            want.add((k, at, v, p, p_at, f, f_at, last, i + 1))
    assert {tuple(r) for r in got.drop(PART).collect()} == want
    if partitions == 40:
        assert placed.filter("k = 1").select(PART).distinct().count() > 5


@pytest.mark.parametrize("partitions", ["3", "30"])
def test_as_of_join(spark, tmp_path, partitions):
    rng = random.Random(1)
    versions = [(k, v, v * 10, (v + 1) * 10 if v < 9 else None, f"{k}-{v}") for k in (1, 2) for v in range(1, 10) if (k, v) != (2, 4)]
    versions += [(1, 8, 70, 70, "empty"), (None, 1, 0, None, "no key")]
    facts = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(120)]), i) for i in range(300)]
    facts += facts[:3]
    v = spark.createDataFrame(versions, "k long, version int, s int, e int, name string")
    f = spark.createDataFrame(facts, "key int, at int, id int").withColumnRenamed("key", "k")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = as_of_join(f, v, ["k"], "at", "s", "e", ["name"], str(tmp_path / "rows"), seq="version")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    def valid(k, at):
        known = [x for x in versions if k is not None and at is not None and x[0] == k and x[2] <= at]
        last = max(known, key=lambda x: (x[2], x[1]), default=None)
        return last[4] if last and (last[3] is None or at < last[3]) else None

    assert sorted(map(str, got.collect())) == sorted(str(Row(k=k, at=at, id=i, name=valid(k, at))) for k, at, i in facts)
