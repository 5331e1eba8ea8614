"""Dimension merges: seed results, edge rows and invariants."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType

from tests.seeds import RUN1, RUN2, T1, T2, TRACKED, batch, staging
from tidemark.operators.scd1 import scd1_merge
from tidemark.operators.scd2 import Scd2
from tidemark.operators.scd3 import scd3_initial, scd3_merge
from tidemark.sinks import overwrite
from tidemark.plans import dimension_refresh
from tidemark.plans.dimension_refresh import (
    CURRENT,
    StoredDimension,
    Type1,
    Type3,
    current_rows,
    read_dimension,
    refresh_dimension,
)

KEYS, TS = ["customer_id"], "last_modified_ts"
SCD = Scd2(KEYS, TRACKED, TS)
FAR = datetime(9999, 12, 31)


@pytest.fixture(scope="module")
def run1(spark):
    return batch(spark, RUN1)


@pytest.fixture(scope="module")
def run2(spark):
    return batch(spark, RUN2)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_type1_keeps_the_newest_row(run1, run2):
    merged = scd1_merge(run1, run2, KEYS, [TS])
    assert rows(merged, "customer_id", "phone") == [
        ("C001", "9999"),
        ("C002", "2222"),
        ("C003", "3333"),
        ("C004", "4444"),
        ("C005", "5555"),
    ]
    assert merged.columns == run1.columns


def test_type1_late_row(spark, run1):
    late = batch(spark, [("C001", "A", "S", "a@x", "Goa", "0", True, T1 - timedelta(days=1))])
    assert rows(scd1_merge(run1, late, KEYS, [TS]), "customer_id", "city")[0] == ("C001", "Pune")
    upserted = scd1_merge(run1, late, KEYS, [TS], incoming_wins=True)
    assert rows(upserted, "customer_id", "city")[0] == ("C001", "Goa")
    assert upserted.count() == 3


def test_type2_seed(run1, run2):
    dim = SCD.initial(run1)
    merged = SCD.merge(dim, run2)
    assert rows(merged, "customer_id", "version", "is_current", "effective_from", "effective_to") == [
        ("C001", 1, False, T1, T2),
        ("C001", 2, True, T2, FAR),
        ("C002", 1, False, T1, T2),
        ("C002", 2, True, T2, FAR),
        ("C003", 1, True, T1, FAR),
        ("C004", 1, True, T2, FAR),
        ("C005", 1, True, T2, FAR),
    ]
    assert merged.columns == dim.columns and merged.dtypes == dim.dtypes


def test_type2_parts_make_up_the_whole(run1, run2):
    dim = SCD.initial(run1)
    changes = SCD.changes(dim, run2)
    assert rows(SCD.changed_keys(changes), "customer_id") == [("C001",), ("C002",)]
    assert rows(SCD.expired(dim, changes), "customer_id", "is_current") == [
        ("C001", False),
        ("C002", False),
    ]
    assert rows(SCD.new_versions(dim, changes), "customer_id", "version") == [
        ("C001", 2),
        ("C002", 2),
    ]
    assert rows(SCD.new_keys(dim, changes), "customer_id", "version") == [("C004", 1), ("C005", 1)]
    assert rows(changes, "customer_id", "change") == [
        ("C001", "changed"),
        ("C002", "changed"),
        ("C003", "absent"),
        ("C004", "new"),
        ("C005", "new"),
    ]


def test_type2_second_application_changes_nothing(run1, run2):
    once = SCD.merge(SCD.initial(run1), run2)
    twice = SCD.merge(once, run2)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_type2_null_changes_and_untracked_columns(spark):
    dim = SCD.initial(
        batch(
            spark,
            [
                ("K1", "a", "b", "e", None, "1", True, T1),
                ("K2", "a", "b", "e", "Pune", "1", True, T1),
                ("K3", "a", "b", "e", None, "1", True, T1),
                ("K4", "a", "b", "old@x", "Pune", "1", True, T1),
            ],
        )
    )
    incoming = batch(
        spark,
        [
            ("K1", "a", "b", "e", "Pune", "1", True, T2),
            ("K2", "a", "b", "e", None, "1", True, T2),
            ("K3", "a", "b", "e", None, "1", True, T2),
            ("K4", "a", "b", "new@x", "Pune", "1", True, T2),
        ],
    )
    changes = SCD.changes(dim, incoming)
    assert rows(changes, "customer_id", "change") == [
        ("K1", "changed"),
        ("K2", "changed"),
        ("K3", "unchanged"),
        ("K4", "unchanged"),
    ]
    kept = SCD.merge(dim, incoming).filter("customer_id = 'K4'").first()
    assert kept.email == "old@x" and kept.version == 1


def test_type2_repeated_keys_in_one_batch(spark, run1):
    repeated = batch(
        spark,
        [
            ("C001", "A", "S", "a", "Goa", "7", True, T2),
            ("C001", "A", "S", "a", "Surat", "8", True, T2 + timedelta(hours=1)),
            ("C009", "N", "N", "n", "Goa", "7", True, T2),
            ("C009", "N", "N", "n", "Surat", "8", True, T2 + timedelta(hours=1)),
        ],
    )
    merged = SCD.current_view(SCD.merge(SCD.initial(run1), repeated))
    assert rows(merged, "customer_id", "city") == [
        ("C001", "Surat"),
        ("C002", "Mumbai"),
        ("C003", "Nagpur"),
        ("C009", "Surat"),
    ]


def test_type2_late_row_leaves_the_intervals_alone(spark, run1):
    late = batch(spark, [("C001", "A", "S", "a", "Goa", "7", True, T1 - timedelta(days=1))])
    dim = SCD.initial(run1)
    merged = SCD.merge(dim, late)
    assert merged.exceptAll(dim).isEmpty() and merged.count() == 3
    applied = replace(SCD, skip_late=False).merge(dim, late)
    assert applied.count() == 4


def test_type2_empty_batch_and_empty_dimension(spark, run1, run2):
    dim = SCD.initial(run1)
    assert SCD.merge(dim, run2.limit(0)).exceptAll(dim).isEmpty()
    first = SCD.merge(dim.limit(0), run2)
    assert rows(first, "customer_id", "version") == [(k, 1) for k in ("C001", "C002", "C004", "C005")]


def test_type2_returning_key_continues_its_numbering(spark, run1):
    dim = SCD.initial(run1)
    closed = dim.withColumn("is_current", F.lit(False)).withColumn("version", F.lit(4))
    back = batch(spark, [("C001", "A", "S", "a", "Goa", "7", True, T2)])
    merged = SCD.merge(closed, back)
    assert rows(merged, "customer_id", "version", "is_current") == [
        ("C001", 4, False),
        ("C001", 5, True),
        ("C002", 4, False),
        ("C003", 4, False),
    ]


def test_type2_two_current_rows_fail_instead_of_losing_one(run1, run2):
    dim = SCD.initial(run1)
    with pytest.raises(PySparkException, match="more than one stored row"):
        SCD.merge(dim.unionAll(dim), run2).collect()


def test_type2_expiry_at_processing_time(run1, run2):
    at = datetime(2026, 1, 4)
    scd = replace(SCD, expire_at=at)
    closed = scd.merge(scd.initial(run1), run2).filter("not is_current")
    assert {r.effective_to for r in closed.collect()} == {at}


SQL_FORM = Scd2(
    ["customer_id"],
    ["full_name", "email", "city"],
    "updated_at",
    valid_from="start_date",
    valid_to="end_date",
    version=None,
    version_key="customer_key",
    current_type=ByteType(),
    open_end=None,
)
JAN10 = datetime(2024, 1, 10, 10)
JAN15 = datetime(2024, 1, 15, 12)
FEB5 = datetime(2024, 2, 5, 9)
MAR1 = datetime(2024, 3, 1, 14)


def test_three_types_side_by_side(spark):
    """One staging table changes three times; each type takes up another change."""
    anjali = (102, "Anjali Patil", "anjali@example.com", "Pune", JAN10)
    first = staging(spark, (101, "Rahul Sharma", "rahul@example.com", "Mumbai", JAN10), anjali)
    mail = staging(spark, (101, "Rahul Sharma", "rahul.new@example.com", "Mumbai", JAN15), anjali)
    pune = staging(spark, (101, "Rahul Sharma", "rahul.new@example.com", "Pune", FEB5), anjali)
    delhi = staging(spark, (101, "Rahul Sharma", "rahul.new@example.com", "Delhi", MAR1), anjali)

    type1 = scd1_merge(first, mail, ["customer_id"], ["updated_at"], incoming_wins=True)
    type2 = SQL_FORM.merge(SQL_FORM.initial(first), pune)
    type3 = scd3_merge(scd3_initial(first, "city"), delhi, ["customer_id"], "city", ["updated_at"])

    assert rows(type1, "customer_id", "email", "city", "updated_at") == [
        (101, "rahul.new@example.com", "Mumbai", JAN15),
        (102, "anjali@example.com", "Pune", JAN10),
    ]
    current = SQL_FORM.current_view(type2)
    assert rows(current, "customer_id", "email", "city", "updated_at", "end_date") == [
        (101, "rahul.new@example.com", "Pune", FEB5, None),
        (102, "anjali@example.com", "Pune", JAN10, None),
    ]
    assert rows(type2.filter("is_current = 0"), "customer_id", "city", "start_date", "end_date") == [
        (101, "Mumbai", JAN10, FEB5)
    ]
    assert type2.select("customer_key").distinct().count() == 3
    assert rows(type3, "customer_id", "city_current", "city_previous", "updated_at") == [
        (101, "Delhi", "Mumbai", MAR1),
        (102, "Pune", None, JAN10),
    ]


def test_type3_seed(run1, run2):
    merged = scd3_merge(scd3_initial(run1, "city"), run2, KEYS, "city", [TS])
    assert rows(merged, "customer_id", "city_current", "city_previous") == [
        ("C001", "Pune - Hinjewadi", "Pune"),
        ("C002", "Mumbai", None),
        ("C003", "Nagpur", None),
        ("C004", "Nashik", None),
        ("C005", "Pune", None),
    ]
    again = scd3_merge(merged, run2, KEYS, "city", [TS])
    assert again.exceptAll(merged).isEmpty()


def test_type3_modes(spark, run1):
    dim = scd3_initial(run1, "city")
    gone = batch(spark, [("C001", "A", "S", None, None, "7", True, T2)])
    patched = scd3_merge(dim, gone, KEYS, "city", [TS]).filter("customer_id = 'C001'").first()
    assert (patched.city_current, patched.city_previous, patched.email) == (
        "Pune",
        None,
        "amit@gmail.com",
    )
    replaced = scd3_merge(dim, gone, KEYS, "city", [TS], mode="replace")
    row = replaced.filter("customer_id = 'C001'").first()
    assert (row.city_current, row.city_previous, row.email) == (None, "Pune", None)
    with pytest.raises(ValueError):
        scd3_merge(dim, gone, KEYS, "city", [TS], mode="other")


@pytest.fixture
def interpreted(spark):
    """Many small refreshes: compiling their plans would take longer than running them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


def random_batches(seed: int, count: int = 4) -> list[list[tuple]]:
    rng = random.Random(seed)
    out = []
    for number in range(count):
        at = T1 + timedelta(days=number)
        keys = rng.sample(range(12), 7)
        out.append(
            [
                (
                    f"K{k:02d}",
                    "f",
                    "l",
                    "e",
                    rng.choice(["Pune", "Goa", None]),
                    rng.choice(["1", "2"]),
                    rng.choice([True, False]),
                    at + timedelta(minutes=rng.randrange(600)),
                )
                for k in keys
            ]
        )
    return out


def replay(batches: list[list[tuple]]) -> list[tuple]:
    """The expected versions, one row at a time."""
    versions: dict[str, list[list]] = {}
    for rows_ in batches:
        for row in rows_:
            key, tracked, at = row[0], row[4:7], row[7]
            known = versions.setdefault(key, [])
            if known and known[-1][1] == tracked:
                continue
            if known:
                known[-1][3] = at
            known.append([len(known) + 1, tracked, at, FAR])
    return sorted(
        (key, number, start, end)
        for key, known in versions.items()
        for number, _, start, end in known
    )


@pytest.mark.parametrize("seed", [1])
def test_type2_agrees_with_a_row_by_row_replay(spark, interpreted, seed, tmp_path):
    batches = random_batches(seed)
    stored = StoredDimension(str(tmp_path), SCD, 4)
    for number, rows_ in enumerate(batches):
        refresh_dimension(stored, batch(spark, rows_), f"r{number}", T1 + timedelta(days=number))
    dim = read_dimension(spark, stored).cache()
    got = rows(dim, "customer_id", "version", "effective_from", "effective_to")
    assert got == replay(batches)
    current = dim.filter("is_current").groupBy("customer_id").count()
    assert current.filter("count <> 1").isEmpty()
    assert current.count() == dim.select("customer_id").distinct().count()
    assert current_rows(spark, stored).count() == current.count()
    latest = None
    for rows_ in batches:
        frame = batch(spark, rows_)
        latest = frame if latest is None else scd1_merge(latest, frame, KEYS, [TS])
    view = SCD.current_view(dim).select("customer_id", *TRACKED)
    assert view.exceptAll(latest.select("customer_id", *TRACKED)).isEmpty()


def test_a_refresh_that_dies_early_is_invisible_and_can_be_repeated(spark, run1, run2, tmp_path, monkeypatch):
    dim = StoredDimension(str(tmp_path), SCD, 4)
    refresh_dimension(dim, run1, "r0", T1)
    with monkeypatch.context() as broken:
        broken.setattr(Scd2, "spliced", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_dimension(dim, run2, "r1", T2)
    assert read_dimension(spark, dim).count() == 3
    refresh_dimension(dim, run2, "r1", T2)
    assert read_dimension(spark, dim).count() == 7
    with pytest.raises(ValueError, match="already published"):
        refresh_dimension(dim, run2, "r1", T2)
    with pytest.raises(ValueError, match="dated before"):
        refresh_dimension(dim, run2, "r2", T1)


@pytest.mark.parametrize("point", ["write", "announce"])
def test_a_refresh_that_dies_late_is_finished_by_the_next(spark, interpreted, run1, run2, tmp_path, monkeypatch, point):
    dim = StoredDimension(str(tmp_path), SCD, 4)
    refresh_dimension(dim, run1, "r0", T1)
    with monkeypatch.context() as broken:
        broken.setattr(overwrite, "remove_folder" if point == "write" else "announce", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_dimension(dim, run2, "r1", T2)
    with pytest.raises(ValueError, match="already published"):
        refresh_dimension(dim, run2, "r1", T2)
    assert read_dimension(spark, dim).count() == 7
    again = run2.withColumn(TS, F.col(TS) + F.expr("interval 1 day"))
    refresh_dimension(dim, again, "r2", T2 + timedelta(days=1))
    got, want = read_dimension(spark, dim), SCD.merge(SCD.merge(SCD.initial(run1), run2), again)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


LOG = "k int, v string, ts timestamp_ntz, seq int"
ORDERED = Scd2(["k"], ["v"], "ts", order_cols=["ts", "seq"])


def moment(n):
    return T1 + timedelta(days=n)


def versions(df):
    return rows(df, "k", "version", "v", "effective_from", "effective_to", "is_current")


def log(spark, *rows_):
    return spark.createDataFrame(list(rows_), LOG)


def test_every_change_of_a_batch_becomes_a_version(spark, tmp_path):
    dim, at = StoredDimension(str(tmp_path), ORDERED, 4), datetime(2024, 1, 1)
    refresh_dimension(dim, log(spark, (1, "v1", moment(0), 1), (2, "x", moment(0), 1)), "r0", at)
    batch1 = log(spark, (1, "v2", moment(1), 1), (1, "v3", moment(1), 2), (1, "v3", moment(2), 1), (1, "v4", moment(3), 1), (3, "n", moment(1), 1), (3, "m", moment(2), 1))
    assert refresh_dimension(dim, batch1, "r1", at).late_keys == 0
    assert versions(read_dimension(spark, dim)) == [
        (1, 1, "v1", moment(0), moment(1), False),
        (1, 2, "v2", moment(1), moment(1), False),
        (1, 3, "v3", moment(1), moment(3), False),
        (1, 4, "v4", moment(3), FAR, True),
        (2, 1, "x", moment(0), FAR, True),
        (3, 1, "n", moment(1), moment(2), False),
        (3, 2, "m", moment(2), FAR, True),
    ]
    # The same time with a higher sequence follows; an earlier change is spliced in.
    batch2 = log(spark, (1, "v5", moment(3), 2), (2, "old", moment(-1), 1), (3, "m", moment(2), 1))
    assert refresh_dimension(dim, batch2, "r2", at).late_keys == 2
    assert rows(current_rows(spark, dim), "k", "version", "v") == [(1, 5, "v5"), (2, 2, "x"), (3, 2, "m")]
    assert versions(read_dimension(spark, dim).filter("k = 2")) == [
        (2, 1, "old", moment(-1), moment(0), False),
        (2, 2, "x", moment(0), FAR, True),
    ]
    with pytest.raises(ValueError, match="lacks"):
        refresh_dimension(dim, batch2.withColumn("extra", F.lit(1)), "r3", at)
    with pytest.raises(ValueError, match="1 rows without a key"):
        refresh_dimension(dim, log(spark, (None, "v", moment(9), 1)), "r3", at)
    with pytest.raises(ValueError, match="1 rows without ts"):
        refresh_dimension(dim, log(spark, (1, "v", None, 1)), "r3", at)
    with pytest.raises(ValueError, match="reserved"):
        refresh_dimension(dim, batch2.withColumn("dim_part", F.lit(1)), "r3", at)
    assert refresh_dimension(dim, batch2.limit(0), "r3", at).buckets == []


def history(rows_):
    """Versions of all rows in order, one row at a time."""
    out = []
    for k in sorted({r[0] for r in rows_}):
        known = []
        for _, v, ts, _ in sorted({r for r in rows_ if r[0] == k}, key=lambda r: (r[2], r[3])):
            if not known or known[-1][2] != v:
                if known:
                    known[-1][4:] = [ts, False]
                known.append([k, len(known) + 1, v, ts, FAR, True])
        out += [tuple(r) for r in known]
    return out


def splice(spark, root, batches, buckets=4):
    dim = StoredDimension(str(root), ORDERED, buckets)
    for n, rows_ in enumerate(batches):
        refresh_dimension(dim, log(spark, *rows_), f"r{n}", T1)
    return dim, versions(read_dimension(spark, dim))


def test_late_rows_split_and_join_versions(spark, interpreted, tmp_path):
    a1, a5, a9 = (1, "a", moment(1), 1), (1, "a", moment(5), 2), (1, "a", moment(9), 3)
    late = [(1, "b", moment(3), 4)], [(1, "c", moment(7), 5)], [(1, "b", moment(6), 6)], [(1, "z", moment(0), 7)]
    batches = [[a1, (2, "q", moment(2), 1)], [a5], [a9], *late]
    dim, seen = StoredDimension(str(tmp_path), ORDERED, 2), []
    for n, rows_ in enumerate(batches):
        refresh_dimension(dim, log(spark, *rows_), f"r{n}", T1)
        got, seen = versions(read_dimension(spark, dim)), seen + rows_
        assert got == history(seen)
    # The same rows once more change nothing.
    again = refresh_dimension(dim, log(spark, *[r for rows_ in batches for r in rows_]), "again", T1)
    assert again.late_keys == 2 and versions(read_dimension(spark, dim)) == got


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_give_the_same_history(spark, interpreted, tmp_path, seed):
    rng = random.Random(seed)
    rows_ = [(rng.randint(1, 5), rng.choice(["a", "b", None]), moment(rng.randint(1, 9)), i) for i in range(40)]
    want = history(rows_)
    rng.shuffle(rows_)
    cuts = sorted(rng.sample(range(1, 40), 2))
    batches = [rows_[lo:hi] for lo, hi in zip([0, *cuts], [*cuts, 40])]
    batches[-1] += batches[0][:5]
    assert splice(spark, tmp_path / "shuffled", batches)[1] == want


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in (root / "data").rglob("*.parquet")}


KINDS = [ORDERED, Type1(["k"], ["ts", "seq"]), Type3(["k"], "v", ["ts", "seq"])]


@pytest.mark.parametrize("kind", KINDS)
def test_a_refresh_writes_the_buckets_of_its_keys_only(spark, tmp_path, kind):
    dim = StoredDimension(str(tmp_path), kind, 32)
    refresh_dimension(dim, log(spark, *[(k, "a", moment(1), k) for k in range(300)]), "r0", T1)
    before = files_of(tmp_path)
    done = refresh_dimension(dim, log(spark, (7, "b", moment(2), 1), (8, "b", moment(2), 1), (7, "a", moment(3), 1)), "r1", T1)
    after = files_of(tmp_path)
    changed = {p.parent for p in set(before) ^ set(after)}
    assert {int(p.parent.name.split("=")[1]) for p in changed} == set(done.buckets) and len(done.buckets) <= 2
    assert current_rows(spark, dim).count() == 300
    if kind is ORDERED:
        history_before = {p for p in after if CURRENT not in p.parent.name}
        assert refresh_dimension(dim, log(spark, (9, "late", moment(0), 1)), "r2", T1).late_keys == 1
        assert history_before <= set(files_of(tmp_path))


def test_stored_types_1_and_3(spark, tmp_path):
    first = [(1, "a", moment(1), 1), (1, "old", moment(0), 1), (2, "x", moment(1), 1)]
    second = [(1, "late", moment(0), 2), (2, "y", moment(2), 1), (3, None, moment(2), 1)]
    found = {}
    for name, kind in (("newest", Type1(["k"], ["ts"])), ("last", Type1(["k"], ["ts"], True)), ("three", Type3(["k"], "v", ["ts"]))):
        dim = StoredDimension(str(tmp_path / name), kind, 3)
        for n, rows_ in enumerate((first, second)):
            refresh_dimension(dim, log(spark, *rows_), f"r{n}", T1)
        found[name] = current_rows(spark, dim)
        with pytest.raises(ValueError, match="without a key"):
            refresh_dimension(dim, log(spark, (None, "v", moment(9), 1)), "r3", T1)
        with pytest.raises(ValueError, match="lacks"):
            refresh_dimension(dim, log(spark, (1, "v", moment(9), 1)).withColumn("extra", F.lit(1)), "r3", T1)
    assert rows(found["newest"], "k", "v") == [(1, "a"), (2, "y"), (3, None)]
    assert rows(found["last"], "k", "v") == [(1, "late"), (2, "y"), (3, None)]
    assert rows(found["three"], "k", "v_current", "v_previous") == [(1, "late", "a"), (2, "y", "x"), (3, None, None)]


def test_merges_refuse_rows_without_a_key(spark):
    good, bad = log(spark, (1, "a", moment(1), 1)), log(spark, (None, "a", moment(1), 1), (None, "b", moment(1), 1))
    for merged in (
        lambda d, b: scd1_merge(d, b, ["k"], ["ts"]),
        lambda d, b: scd3_merge(scd3_initial(d, "v"), b, ["k"], "v", ["ts"]),
        lambda d, b: ORDERED.merge(ORDERED.initial(d), b),
    ):
        for pair in ((good, bad), (bad, good)):
            with pytest.raises(PySparkException, match="row without a key"):
                merged(*pair).collect()


def test_a_refresh_meets_the_stored_rows_once(spark, tmp_path, monkeypatch):
    """What is stored comes from the settled outcome of one join: without late rows no step reads the table again."""
    dim, replace, read = StoredDimension(str(tmp_path), ORDERED, 2), dimension_refresh.replace_partitions, []

    def replaced(rows_, *args):
        read.append([f for f in rows_.inputFiles() if "/data/" in f])
        replace(rows_, *args)

    monkeypatch.setattr(dimension_refresh, "replace_partitions", replaced)
    first = [(k, "v", moment(0), 1) for k in range(8)]
    later = [(k, "w", moment(1), 1) for k in range(4)] + [(9, "x", moment(1), 1)]
    refresh_dimension(dim, log(spark, *first), "r0", T1)
    assert refresh_dimension(dim, log(spark, *later), "r1", T1).late_keys == 0
    assert read == [[], []]
    assert versions(read_dimension(spark, dim)) == history([*first, *later])
