"""Every operator against plain Python, on given tables and on awkward rows."""

from __future__ import annotations

import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import reference as ref
from tests.oracle import duck_rows, spark_rows
from tidemark.llm import langid, licenses, mixing, neighbours, parity, paths, quality, repeats, warc
from tidemark.llm.common import Scratch
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.suffixes import suffix_array

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, print long, minimizer string, n int"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["the", "of", "tion", "And", "anble", "oré", "x|y", "thwh.", "in"]) + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward():
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies, shared passages."""
    rng = random.Random(5)
    passage, long = prose(rng, 70), prose(rng, 6000)
    base = prose(rng, 200)
    near = base.split(" ")
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "two words"), (5, "two words"), (6, "ONE"), (7, long), (8, long + " end")]
    rows += [(10, base), (11, base), (None, base), (12, base.upper()), (13, " ".join([*near[:100], "new", *near[101:]]))]
    rows += [(20 + i, f"{prose(rng, 30)} {passage} {prose(rng, 5 + i)}") for i in range(6)]
    rows += [(30, "same " * 300), (31, "same " * 300 + "x"), (32, "a" * 200), (33, "b" + "a" * 120), (34, None), (None, None)]
    rows += [(13, "another text of the same id"), (40, base + "\n" + passage), (9, passage)]
    return [(d, t, "en", None if d and d % 3 == 0 else f"s{(d or 0) % 4}", 0, 1, "x", 2) for d, t in rows]


@pytest.fixture(scope="module")
def frame(spark, awkward):
    return spark.createDataFrame(awkward, DOCS).repartition(3)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def pairs(df) -> list[tuple]:
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def table(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def query_rows(spark, monkeypatch, df, name):
    """The rows of a registered query over another documents table."""
    path = Scratch(spark, "fixture").path("docs")
    df.write.parquet(f"{path}/documents.parquet")
    return table(QUERIES[name](spark, path))


@pytest.mark.parametrize("rows", ["frame", "given"])
@pytest.mark.parametrize(
    "name, plain", [("op4_parity", ref.near_duplicate_groups), ("op5_repeats", ref.repeated_bytes), ("op7_paths", ref.repeated_words)]
)
def test_copies(spark, monkeypatch, request, rows, name, plain):
    df = request.getfixturevalue(rows)
    assert query_rows(spark, monkeypatch, df, name) == Counter(plain(pairs(df)))


@pytest.mark.parametrize("name", ["op2_licenses", "op4_parity", "op5_repeats", "op6_quality", "op7_paths", "op8_language_id", "op9_mixing", "op10_pieces"])
def test_empty_tables(spark, monkeypatch, frame, name):
    assert query_rows(spark, monkeypatch, frame.limit(0), name) == Counter()


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(500):
        text = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_common_strings_beyond_a_block(spark, monkeypatch, frame):
    monkeypatch.setattr(repeats, "MOST", 1)
    assert query_rows(spark, monkeypatch, frame, "op5_repeats") == Counter(ref.repeated_bytes(pairs(frame)))


@pytest.mark.parametrize("rounds, block", [(parity.ROUNDS, parity.BLOCK), (0, 7)])
def test_a_group_of_near_copies_is_one_component(spark, monkeypatch, rounds, block):
    monkeypatch.setattr(parity, "ROUNDS", rounds)
    monkeypatch.setattr(parity, "BLOCK", block)
    rng = random.Random(3)
    base = prose(rng, 400).split(" ")
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(400), 7):
            w[k] = f"new{i}-{k}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = parity.grouped(df, Scratch(spark, "near")).select("doc_id", "n_shingles", "component_id")
    assert table(got) == Counter(ref.near_duplicate_groups(rows))


def test_bit_sketches_bound_the_symmetric_difference():
    rng = np.random.default_rng(1)
    for n in (3, 40, 500, 3000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[n // 10 :], rng.integers(0, 2**63, n, dtype=np.uint64)[: n // 8])))
        x, y = parity.bit_sketch(a), parity.bit_sketch(b)
        size = min(len(x), len(y))
        differing = int(np.bitwise_count(parity.folded(x, size) ^ parity.folded(y, size)).sum())
        assert differing <= len(np.setxor1d(a, b))


def test_bands_never_lose_a_pair():
    bands = parity.bands_for()
    lows = np.array(bands.lows)
    for a in [*range(1, 400), 5000, 77777]:
        g = int(np.searchsorted(lows, a, "right")) - 1
        b = a * 100 // 85
        assert b <= bands.reach[g]
        own = int(np.searchsorted(lows, b, "right")) - 1
        assert own - g in (0, 1)
        most = 15 * a // 85  # symmetric difference of sets of sizes a and b at the threshold
        assert most == 0 or bands.words[g] - bands.spare[g] > most


def test_first_of_each_keeps_all_columns(spark, frame):
    kept = parity.first_of_each(frame, Scratch(spark, "first"))
    assert kept.columns == frame.columns
    rows = pairs(frame)
    groups = ref.near_duplicate_groups(rows)
    want = Counter(row for row, (d, _, c) in zip(rows, groups) if d is None or c == d)
    assert Counter(pairs(kept)) == want
    ids = Counter(d for d, _ in want.elements())
    assert ids[10] == 1 and ids[11] == 0 and ids[13] == 1 and ids[5] == 2 and ids[None] == 2


def test_cut_removes_the_repeated_words_only(spark, frame):
    got = paths.cut(frame, Scratch(spark, "cut"))
    assert got.columns == frame.columns and got.count() == frame.count()
    want = Counter((d, h) for d, _, _, h in ref.repeated_words(pairs(frame)))
    assert Counter((d, ref.sha(" ".join(ref.words(t)).encode())) for d, t in pairs(got)) == want
    before, after = dict(pairs(frame.filter("doc_id < 8"))), dict(pairs(got.filter("doc_id < 8")))
    assert before == after


def page_rows():
    html = ["<p>" + "x" * 200, "short", None, "é" * 60, "<p>" + "x" * 200, "short", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9]
    rows = [(i, f"http://h/{i}\r\nX: y" if i == 2 else f"http://h/{i}", h) for i, h in enumerate(html * 2)]
    return rows + [(None, None, "<p>" + "x" * 200), (0, "http://h/0", html[0]), (99, "u", "n" * 150), (99, "u", "n" * 150)]


def test_archives(spark):
    df = spark.createDataFrame(page_rows(), "page_id long, url string, html string").withColumn("original", F.lit(1)).repartition(3)
    scratch = Scratch(spark, "warc")
    path = scratch.path("archives")
    warc.write_archives(df, path)
    got = table(warc.resolve(warc.read_headers(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    least = {}
    for i, _, h in page_rows():
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            least[data] = min(least.get(data, i), i)
    want = Counter()
    for i, _, h in page_rows():
        data = (h or "").encode()
        first = least.get(data)
        revisit = first is not None and first != i
        want[(i, len(data), ref.sha(data), "revisit" if revisit else "response", first if revisit else None)] += 1
    assert got == want
    empty = scratch.path("empty")
    warc.write_archives(df.limit(0), empty)
    assert warc.resolve(warc.read_headers(spark, empty)).count() == 0


def test_archive_parser_reads_plain_and_packed_members():
    import gzip

    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nab\r\n\r\r\n\r\n"
    for content in (record * 2, gzip.compress(record * 2), gzip.compress(record) + gzip.compress(record)):
        assert [block for _, block in warc.parse(content)] == [b"ab\r\n\r"] * 2
    with pytest.raises(ValueError):
        list(warc.parse(record[:-6]))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for source in ("pages", "documents"):
        con.sql(f"CREATE VIEW {source} AS SELECT * FROM '{SF_DIR}/{source}.parquet'")
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duck_rows(con, ORACLES[name])


def scanned(text: str | None) -> tuple:
    t = (text or "").translate(ref.LOWER)
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    w, starts, labels = pattern.findall(t), [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    more, score = set(labels), 1.0 if starts else 0.0
    for line in t.split("\n"):
        for _, label, need in licenses.template_words():
            k = len(set(pattern.findall(line)) & set(need))
            if 10 * k >= 9 * len(need):
                more.add(label)
                score = max(score, k / len(need))
    base, both = ",".join(sorted(labels)), ",".join(sorted(more))
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), base, both, score


LICENSED = [
    "mit license MIT License mit-license",
    "x gnu General, public license apache license\nReleased under the MIT licence",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation",
    "This is free and unencumbered software released into the public domain, ok",
    "cc by cc by é cc-by",
    None,
    "",
    "mit\nlicense",
]


def test_licenses(spark, given):
    rows = [(i, t) for i, t in enumerate(LICENSED)] + [(0, "mit license"), (None, LICENSED[0]), (0, LICENSED[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit(1))
    for docs in (df, given):
        got = table(licenses.scan(docs, Scratch(spark, "licenses")))
        assert got == Counter((d, *scanned(t)) for d, t in pairs(docs))


def test_quality_base(spark, frame, given):
    for docs in (frame, given):
        rows = quality.judged(Scratch(spark, "quality").save(quality.features(docs), "features"))
        got = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
        want = Counter()
        for d, t in pairs(docs):
            base = ref.quality_base(t)
            want[(d, *base, base[0] < 50 or 100 * base[4] > 50 * base[0])] += 1
        assert Counter(map(tuple, got)) == want


def test_quality_keeps_clean_and_drops_noisy_texts(spark):
    got = QUERIES["op6_quality"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = got.filter("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in rows}
    assert kept[1] > 0.98 and kept[0] < 0.2


def test_estimation_recovers_a_worthless_rule():
    rng = random.Random(2)
    seen = Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        seen[(*[(1 if good else -1) if rng.random() < 0.9 else (-1 if good else 1) for _ in range(3)], rng.choice([-1, 1]))] += 1
    prior, ratios = quality.estimate(sorted(seen.items()))
    assert 0.5 < prior < 1.2
    assert all(r[1] > 1 and r[-1] < -1 for r in ratios[:3])
    assert abs(ratios[3][1]) < 0.3 and abs(ratios[3][-1]) < 0.3


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").filter("held_out").join(docs, "doc_id")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_edges(spark, frame):
    models = langid.fit(spark.createDataFrame([(1, "the of and", "en"), (2, "le la les des", "fr"), (3, None, "de"), (4, "x", None)], "doc_id long, text string, lang string"))
    assert list(models) == ["en", "fr"]
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "le la les des"), (5, "the of and"), (5, "the of and")], "id int, text string")
    got = sorted((r.id, r[2].lang_pred, r[2].rejected) for r in langid.predict(rows, models).collect())
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert got[3:] == [(4, "fr", False), (5, "en", False), (5, "en", False)]
    assert {r[2].lang_pred for r in langid.predict(rows, {}).collect()} == {"und"}


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    whole, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        if not free or not whole:
            return {s: 3.0 * sizes[s] if s in stopped else 0.0 for s in names}
        level = (whole - sum(3 * sizes[s] for s in stopped)) / sum(weight[s] for s in free)
        new = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not new:
            return {s: 3.0 * sizes[s] if s in stopped else weight[s] * level for s in names}
        stopped |= new


@pytest.mark.parametrize("rows", ["frame", "given"])
def test_mixing(spark, request, rows):
    docs = request.getfixturevalue(rows)
    got = mixing.mixing_plan(docs, Scratch(spark, "mix")).collect()
    sizes = Counter()
    for r in docs.select("text", "source").collect():
        sizes[r.source] += len(ref.words(r.text))
    want = plain_targets(dict(sizes))
    assert len(got) == docs.count()
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.taken == r["size"] * r.copies and r.copies <= 3 and int(r.rate) <= r.copies <= int(r.rate) + 1
        taken[r.source] += r.taken
    if rows == "given":
        assert all(abs(taken[s] - want[s]) <= 0.25 * want[s] for s in want)
    again = mixing.mix(docs, Scratch(spark, "mix"))
    assert again.columns == docs.columns
    expected = Counter()
    for r in got:
        expected[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in again.select("doc_id").collect()) == +expected


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1500, 12)).astype(np.float32)
    points[200:700] = points[200]  # a vector with a third of all rows
    rows = [(i, [float(x) for x in p], 1) for i, p in enumerate(points)]
    odd = [(5000, None, 0), (5100, [0.0] * 12, 0), (5200, [float("nan")] * 12, 0), (5300, [1.0], 0), (5400, [None] * 12, 0), (None, rows[3][1], 0), rows[7]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, list int").repartition(4)
    got = {}
    for r in neighbours.search(df, Scratch(spark, "near"), list_size=50).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 100))
    hits = 0
    exact = points.astype(float)
    for q, found in got.items():
        d = np.sqrt(((exact - exact[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.argsort(d, kind="stable")[:10].tolist()
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 11)) and all(abs(s - d[i]) < 1e-9 for _, i, s in found)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(want))
    assert hits >= 9 * len(got)
    assert [i for _, i, _ in got[300]] == list(range(200, 210))
    assert neighbours.search(df.limit(0), Scratch(spark, "near")).count() == 0
    few = neighbours.search(df.filter("vec_id in (100, 101, 102)"), Scratch(spark, "near")).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(100, 1), (100, 2)]
