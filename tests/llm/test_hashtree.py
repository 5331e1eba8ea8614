"""The hash tree: brute force, movement when trees change, awkward rows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import SF_DIR
from tidemark.llm.common import Scratch
from tidemark.llm.hashtree import SHARDS, Tree, assign, shard_of, shard_rows, write_shards
from tidemark.llm.queries import QUERIES


def plain_shard(tree: Tree, doc_id) -> int:
    key, path = "" if doc_id is None else str(doc_id), ()
    for depth in range(3):
        weights = defaultdict(float)
        for *place, weight in tree.shards:
            if tuple(place[:depth]) == path:
                weights[tuple(place[: depth + 1])] += weight

        def draw(child):
            digest = hashlib.md5(f"{key}|{'/'.join(map(str, child))}".encode()).hexdigest()[:15]
            return -math.log((int(digest, 16) + 1) / 16**15) / weights[child]

        path = min(weights, key=draw)
    return path[2]


def shards(spark, tree, n=4000):
    rows = spark.range(n).select("id", shard_of(tree, F.col("id")).alias("shard")).collect()
    return {r.id: r.shard for r in rows}


UNEVEN = Tree((("a", "x", 0, 1.0), ("a", "x", 1, 3.0), ("a", "y", 2, 2.0), ("b", "x", 3, 4.0), ("b", "z", 4, 0.5)))


@pytest.mark.parametrize("tree", [SHARDS, SHARDS.with_shard(), UNEVEN, Tree.even(1, 1, 1)])
def test_descent(spark, tree):
    got = shards(spark, tree, 500)
    assert got == {i: plain_shard(tree, i) for i in range(500)}


def test_rows_follow_the_weights(spark):
    found = Counter(shards(spark, UNEVEN, 21_000).values())
    for _, _, shard, weight in UNEVEN.shards:
        assert abs(found[shard] - weight * 2000) < 5 * math.sqrt(weight * 2000)


@pytest.mark.parametrize("tree", [SHARDS, SHARDS.with_shard().with_shard(), UNEVEN])
def test_a_new_shard_takes_rows_into_itself_only(spark, tree):
    before, after = shards(spark, tree), shards(spark, tree.with_shard())
    moved = {after[i] for i in before if before[i] != after[i]}
    assert moved == {len(tree.shards)}


def test_movement_stays_within_changed_subtrees(spark):
    region = {n: a for a, _, n, _ in UNEVEN.shards}
    rack = {n: (a, b) for a, b, n, _ in UNEVEN.shards}
    before, after = shards(spark, UNEVEN), shards(spark, UNEVEN.reweighted(2, 6.0))
    for i in before:
        if before[i] != after[i]:
            assert region[after[i]] == "a"  # only region a gained weight
            assert region[before[i]] == "b" or rack[after[i]] == ("a", "y")
    joined = shards(spark, UNEVEN.in_rack("b", "z", 1.0))
    for i in before:
        if before[i] != joined[i]:
            assert joined[i] == 5 or region[joined[i]] == "b"


@pytest.mark.parametrize("bad", [(), (("a", "b", 1, 1.0),), (("a", "b", 0, 0.0),), (("a", "b", 0, 1.0), ("a", "b", 0, 1.0)), (("a", "b", 0, math.nan),)])
def test_bad_trees_are_refused(bad):
    with pytest.raises(ValueError):
        Tree(bad)


AWKWARD = "doc_id long, text string, shard string, slot int, n long, tie long, name string"


def test_awkward_rows(spark):
    texts = [None, "", "é" * 40, "x" * 100_000, "same", "same"]
    rows = [(i, t) for i, t in enumerate(texts * 10)] + [(None, "a"), (None, None), (None, "a"), (3, "x"), (3, "x"), (-1, "y")]
    frame = spark.createDataFrame([(d, t, "s", 1, 2, 3, "n") for d, t in rows], AWKWARD).repartition(4)
    got = shard_rows(frame, SHARDS, SHARDS.with_shard(), Scratch(spark, "shards")).collect()
    data = [(d, (t or "").encode()) for d, t in rows]
    want = Counter((d, len(b) + 8, zlib.crc32(b), plain_shard(SHARDS, d), plain_shard(SHARDS.with_shard(), d)) for d, b in data)
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_rows(frame.limit(0), SHARDS, SHARDS, Scratch(spark, "none")).count() == 0


def test_reruns_agree_and_law_holds(spark):
    first = QUERIES["op13_shards"](spark, SF_DIR).collect()
    assert Counter(first) == Counter(QUERIES["op13_shards"](spark, SF_DIR).collect())
    assert all(r.law == "key" and 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) for r in first)


def test_written_shards(spark):
    docs = spark.createDataFrame([(i % 97, f"t{i}", "k") for i in range(300)] + [(None, None, None)], "doc_id long, text string, `a.b` string")
    path = Scratch(spark, "files").path("shards")
    write_shards(docs, SHARDS, path)
    back = spark.read.parquet(path)
    want = Counter((r.doc_id, r.text, r["a.b"], plain_shard(SHARDS, r.doc_id)) for r in docs.collect())
    assert Counter((r.doc_id, r.text, r["a.b"], r.shard) for r in back.collect()) == want
    with pytest.raises(ValueError):
        assign(docs.withColumn("shard", F.lit(1)), SHARDS)
    assert assign(docs.withColumn("shard", F.lit(1)), SHARDS, name="place").columns == ["doc_id", "text", "a.b", "shard", "place"]
