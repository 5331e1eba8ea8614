"""Incremental loading: slices, bookmarks, replay after a crash, streams."""

from __future__ import annotations

from decimal import Decimal
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import digests
from tidemark.operators.bookmarks import (
    BOOKMARK_SCHEMA,
    EPOCH,
    current_bookmarks,
    get_bookmark,
    seed_bookmarks,
    upsert_bookmark,
)
from tidemark.operators.incremental import incremental_slice, with_ingest_metadata
from tidemark.operators.latest import latest_per_key, live_rows
from tidemark.plans import incremental_job
from tidemark.plans.incremental_job import Landing, read_landed, run_incremental
from tidemark.sinks.files import write_files
from tidemark.sources.files import read_files, read_or_empty
from tidemark.plans.dimension_refresh import StoredDimension, Type1, current_rows
from tidemark.streaming.landing_stream import keep_refreshed, landed_stream, run_available

SCHEMA = "customer_id string, address string, is_deleted boolean, lastmodified timestamp_ntz"
NOON = datetime(2026, 1, 3, 12)
AS_OF = datetime(2026, 1, 5)


def at(minutes: int) -> datetime:
    return NOON + timedelta(minutes=minutes)


def source(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], SCHEMA)


def bookmarks(spark, *rows):
    return spark.createDataFrame(list(rows), BOOKMARK_SCHEMA)


INSERTS = [
    ("C001", "Pune", False, at(0)),
    ("C002", "Mumbai", False, at(0)),
    ("C003", "Nagpur", False, at(0)),
]


def test_slice_bounds(spark):
    df = source(spark, *[(f"C{i}", "x", False, at(i)) for i in range(5)])
    ids = lambda d: sorted(r.customer_id for r in d.collect())
    assert ids(incremental_slice(df, "lastmodified")) == ["C0", "C1", "C2", "C3", "C4"]
    assert ids(incremental_slice(df, "lastmodified", at(1), at(3))) == ["C2", "C3"]
    assert ids(incremental_slice(df, "lastmodified", hi=at(1))) == ["C0", "C1"]
    again = incremental_slice(df, "lastmodified", at(2), at(3), overlap=timedelta(minutes=1))
    assert ids(again) == ["C2", "C3"]


def test_slice_ignores_the_session_time_zone(spark):
    df = source(spark, ("C1", "x", False, at(0)), ("C2", "x", False, at(1)))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        kept = incremental_slice(df, "lastmodified", at(0), at(1)).collect()
        assert [r.customer_id for r in kept] == ["C2"]
        stamped = with_ingest_metadata(df, AS_OF).first()
        assert (stamped.ingested_at, str(stamped.ingest_date)) == (AS_OF, "2026-01-05")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bookmarks(spark):
    known = bookmarks(spark, ("a", at(1), AS_OF), ("b", at(2), AS_OF), ("c", at(3), AS_OF))
    moved = upsert_bookmark(known, "b", at(9), AS_OF)
    assert {r.table_name: r.last_value for r in moved.collect()} == {
        "a": at(1),
        "b": at(9),
        "c": at(3),
    }
    assert get_bookmark(known, "b") == at(2)
    assert get_bookmark(known, "nothing") is None
    wanted = spark.createDataFrame([("a",), ("d",), ("d",)], "table_name string")
    seeded = seed_bookmarks(known, wanted, AS_OF)
    assert {r.table_name: r.last_value for r in seeded.collect()} == {
        "a": at(1),
        "b": at(2),
        "c": at(3),
        "d": EPOCH,
    }
    log = known.unionByName(bookmarks(spark, ("a", at(7), AS_OF)))
    assert get_bookmark(current_bookmarks(log), "a") == at(7)


def test_soft_delete_and_restore(spark):
    log = source(
        spark,
        *INSERTS,
        ("C001", "Pune - Hinjewadi", False, at(1)),
        ("C002", "Mumbai", True, at(2)),
        ("C003", "Nagpur", True, at(2)),
        ("C003", "Nagpur", False, at(3)),
    )
    live = live_rows(log, ["customer_id"], ["lastmodified"], F.col("is_deleted"))
    assert sorted((r.customer_id, r.address) for r in live.collect()) == [
        ("C001", "Pune - Hinjewadi"),
        ("C003", "Nagpur"),
    ]


def test_latest_does_not_depend_on_row_order(spark):
    tied = [("C1", f"city {i}", False, at(0)) for i in range(50)]
    picks = {
        latest_per_key(source(spark, *rows).repartition(n), ["customer_id"], ["lastmodified"])
        .first()
        .address
        for rows, n in [(tied, 1), (tied[::-1], 3), (tied, 7)]
    }
    assert len(picks) == 1


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_incremental_job(spark, tmp_path, fmt):
    landing = Landing(str(tmp_path), fmt)
    rows = list(INSERTS)

    def load(hi=AS_OF):
        return run_incremental(
            spark, "customers", source(spark, *rows), "lastmodified", landing, AS_OF, hi
        )

    first = load()
    assert (first.rows, first.bookmark_before, first.bookmark_after) == (3, None, at(0))

    idle = load()
    assert (idle.rows, idle.bookmark_after, idle.batch_path) == (0, at(0), None)

    rows[0] = ("C001", "Pune, Hinjewadi", False, at(1))
    rows[1] = ("C002", "Mumbai", True, at(2))
    second = load(hi=at(1))
    assert (second.rows, second.bookmark_after) == (1, at(1))
    third = load()
    assert (third.rows, third.bookmark_before, third.bookmark_after) == (1, at(1), at(2))

    landed = read_landed(spark, "customers", landing, source(spark, *rows).schema)
    assert landed.count() == 5
    latest = latest_per_key(landed, ["customer_id"], ["lastmodified"]).drop(
        "ingested_at", "ingest_date"
    )
    assert latest.exceptAll(source(spark, *rows)).isEmpty() and latest.count() == 3
    assert get_bookmark(landing.bookmarks(spark), "customers") == at(2)


def test_change_column_with_time_zone(spark, tmp_path):
    df = source(spark, *INSERTS, ("C004", "Goa", False, at(5))).withColumn(
        "lastmodified", F.col("lastmodified").cast("timestamp")
    )
    landing = Landing(str(tmp_path))
    first = run_incremental(spark, "s", df, "lastmodified", landing, AS_OF, at(0))
    second = run_incremental(spark, "s", df, "lastmodified", landing, AS_OF)
    assert (first.rows, first.bookmark_after, second.rows, second.bookmark_after) == (
        3,
        at(0),
        1,
        at(5),
    )


def test_sources_keep_separate_bookmarks(spark, tmp_path):
    landing = Landing(str(tmp_path))
    df = source(spark, *INSERTS)
    for name, hi in [("a", at(0)), ("b", at(0))]:
        run_incremental(spark, name, df, "lastmodified", landing, AS_OF, hi)
    more = source(spark, *INSERTS, ("C009", "Goa", False, at(5)))
    run_incremental(spark, "a", more, "lastmodified", landing, AS_OF)
    marks = {r.table_name: r.last_value for r in landing.bookmarks(spark).collect()}
    assert marks == {"a": at(5), "b": at(0)}


def test_slices_add_up_to_the_full_load(spark, tmp_path):
    rows = [(f"C{i:03d}", "x", i % 2 == 0, at(i // 3)) for i in range(40)]
    df = source(spark, *rows)
    landing = Landing(str(tmp_path))
    total = 0
    for hi in [at(2), at(2), at(7), at(100)]:
        total += run_incremental(spark, "s", df, "lastmodified", landing, AS_OF, hi).rows
    landed = read_landed(spark, "s", landing, df.schema).drop("ingested_at", "ingest_date")
    assert total == 40
    assert landed.exceptAll(df).isEmpty() and df.exceptAll(landed).isEmpty()


def test_crash_between_landing_and_bookmark(spark, tmp_path, monkeypatch):
    landing = Landing(str(tmp_path))
    df = source(spark, *INSERTS)
    real = incremental_job.write_files

    def failing(frame, path, *args, **kwargs):
        if path == landing.log_path:
            raise RuntimeError("driver lost")
        real(frame, path, *args, **kwargs)

    monkeypatch.setattr(incremental_job, "write_files", failing)
    with pytest.raises(RuntimeError):
        run_incremental(spark, "s", df, "lastmodified", landing, AS_OF)
    assert get_bookmark(landing.bookmarks(spark), "s") is None
    assert read_landed(spark, "s", landing, df.schema).count() == 0

    monkeypatch.setattr(incremental_job, "write_files", real)
    later = AS_OF + timedelta(days=1)
    again = run_incremental(spark, "s", df, "lastmodified", landing, later)
    assert again.rows == 3
    assert read_landed(spark, "s", landing, df.schema).count() == 3


def test_overlap_picks_up_a_late_commit_in_the_bookmarks_own_second(spark, tmp_path):
    landing = Landing(str(tmp_path))
    run_incremental(spark, "s", source(spark, *INSERTS), "lastmodified", landing, AS_OF)
    grown = source(spark, *INSERTS, ("C004", "Goa", False, at(0)))
    plain = run_incremental(spark, "s", grown, "lastmodified", landing, AS_OF)
    assert plain.rows == 0
    second = timedelta(seconds=1)
    wide = run_incremental(
        spark, "s", grown, "lastmodified", landing, AS_OF, overlap=second
    )
    assert (wide.rows, wide.bookmark_after) == (4, at(0))
    landed = read_landed(spark, "s", landing, grown.schema)
    assert latest_per_key(landed, ["customer_id"], ["lastmodified"]).count() == 4
    run_incremental(spark, "s", grown, "lastmodified", landing, AS_OF, overlap=second)
    assert read_landed(spark, "s", landing, grown.schema).count() == 7


def test_only_a_missing_path_counts_as_empty(spark, tmp_path):
    assert read_or_empty(spark, str(tmp_path / "none"), BOOKMARK_SCHEMA).count() == 0
    with pytest.raises(Exception):
        read_or_empty(spark, "nosuchscheme://x/y", BOOKMARK_SCHEMA)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "broken"), BOOKMARK_SCHEMA).count()


def test_formats(spark, tmp_path):
    with pytest.raises(ValueError, match="format"):
        write_files(spark.range(1), str(tmp_path / "x"), "orc")
    with pytest.raises(ValueError, match="schema"):
        read_files(spark, str(tmp_path / "x"), "csv")
    df = source(spark, ("C1", 'a "quoted", text', None, at(0)), ("C2", None, True, at(1)))
    write_files(df, str(tmp_path / "csv"), "csv")
    write_files(df, str(tmp_path / "csv"), "csv")
    back = read_files(spark, str(tmp_path / "csv"), "CSV", df.schema)
    assert back.count() == 4 and back.dtypes == df.dtypes
    assert back.exceptAll(df.unionAll(df)).isEmpty()


LATEST = Type1(["customer_id"], ["lastmodified"])


def test_stream_takes_up_each_file_once(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = source(spark, *INSERTS)
    write_files(df, landing)
    table = StoredDimension(target, LATEST, 4)
    handler = keep_refreshed(table, AS_OF)

    def run():
        run_available(landed_stream(spark, landing, df.schema), handler, str(tmp_path / "cp"))
        return {r.customer_id: r.address for r in current_rows(spark, table).collect()}

    assert run() == {"C001": "Pune", "C002": "Mumbai", "C003": "Nagpur"}
    assert run() == {"C001": "Pune", "C002": "Mumbai", "C003": "Nagpur"}
    write_files(source(spark, ("C001", "Goa", False, at(4)), ("C002", "old", False, at(-9))), landing)
    assert run() == {"C001": "Goa", "C002": "Mumbai", "C003": "Nagpur"}
    handler(source(spark, ("C003", "repeated batch", False, at(99))), 0)
    assert {r.address for r in current_rows(spark, table).collect()} == {
        "Goa",
        "Mumbai",
        "Nagpur",
    }


def test_stream_with_a_new_checkpoint_loses_no_row(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    table = StoredDimension(target, LATEST, 4)
    handler = keep_refreshed(table, AS_OF)
    write_files(source(spark, *INSERTS), landing)
    run_available(landed_stream(spark, landing, source(spark).schema), handler, str(tmp_path / "first"))
    write_files(source(spark, ("C009", "Goa", False, at(4))), landing)
    again = keep_refreshed(table, AS_OF)
    run_available(landed_stream(spark, landing, source(spark).schema), again, str(tmp_path / "second"))
    assert current_rows(spark, table).count() == 4


def test_rows_without_a_change_time_are_never_lost(spark, tmp_path):
    df = source(spark, *INSERTS, ("C009", "Goa", False, None))
    landing = Landing(str(tmp_path))
    with pytest.raises(incremental_job.MissingChangeTime, match="1 rows"):
        run_incremental(spark, "s", df, "lastmodified", landing, AS_OF)
    assert read_landed(spark, "s", landing, df.schema).count() == 0
    done = run_incremental(spark, "s", df, "lastmodified", landing, AS_OF, quarantine=True)
    assert (done.rows, done.quarantined, done.bookmark_after) == (3, 1, at(0))
    aside = read_files(spark, landing.quarantine("s"), schema=df.schema)
    assert aside.select("customer_id").first()[0] == "C009"


def test_overlap_never_overwrites_a_committed_batch(spark, tmp_path):
    landing, second = Landing(str(tmp_path)), timedelta(seconds=1)

    def load(*rows):
        df = source(spark, *rows)
        done = run_incremental(spark, "s", df, "lastmodified", landing, AS_OF, overlap=second)
        landed = read_landed(spark, "s", landing, df.schema).collect()
        return done.rows, sorted((r.customer_id, r.address) for r in landed)

    assert load(("a", "x", False, at(0))) == (1, [("a", "x")])
    late = ("c", "late", False, at(0))
    assert load(("a", "x", False, at(0)), late) == (2, [("a", "x"), ("a", "x"), ("c", "late")])
    rows, landed = load(("a", "x2", False, at(0)), ("c", "late2", False, at(0)))
    assert rows == 2 and set(landed) == {("a", "x"), ("c", "late"), ("a", "x2"), ("c", "late2")}
    assert load() == (0, landed)
    assert load(("a", "x2", False, at(0))) == (0, landed)


@pytest.mark.parametrize(
    "kind, values",
    [("bigint", [3, 7, 9]), ("date", [datetime(2024, 1, d).date() for d in (1, 5, 9)])],
)
def test_bookmarks_of_other_types(spark, tmp_path, kind, values):
    landing = Landing(str(tmp_path))
    schema = f"id int, changed {kind}"
    rows = [(i, v) for i, v in enumerate(values)]

    def load(n, hi=None):
        df = spark.createDataFrame(rows[:n], schema)
        return run_incremental(spark, "s", df, "changed", landing, AS_OF, hi)

    assert (load(1).bookmark_after, load(1).rows) == (values[0], 0)
    assert (load(3, hi=values[1]).rows, load(3).bookmark_after) == (1, values[2])
    assert load(3).rows == 0


AWKWARD = ["", " ", " x ", "a\nb", "a\r\nb", '"q"', "\\", "\\n", "\\\n", "\\N", "a,b", None, "#", '\\"', "é\t"]


def test_csv_keeps_every_value(spark, tmp_path):
    rows = [(i, t, datetime(2024, 1, 1, 1, 2, 3, i), datetime(2024, 1, 1, 1, 2, 3, 999_999 - i), 0.1 * i) for i, t in enumerate(AWKWARD)]
    rows.append((None, None, None, None, None))
    df = spark.createDataFrame(rows, "i int, t string, n timestamp_ntz, z timestamp, d double")
    write_files(df, str(tmp_path / "csv"), "csv")
    back = read_files(spark, str(tmp_path / "csv"), "csv", df.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_csv_landing_is_idle_when_nothing_changed(spark, tmp_path):
    landing = Landing(str(tmp_path), "csv")
    df = source(spark, ("a", "x", False, at(0) + timedelta(microseconds=123456)))
    assert run_incremental(spark, "s", df, "lastmodified", landing, AS_OF).rows == 1
    assert run_incremental(spark, "s", df, "lastmodified", landing, AS_OF).rows == 0
    assert read_landed(spark, "s", landing, df.schema).first().lastmodified == at(0) + timedelta(microseconds=123456)


def test_idle_overlap_reads_the_batches_of_the_overlap_only(spark, tmp_path):
    landing, rows = Landing(str(tmp_path)), [(f"c{i}", "x", False, at(i)) for i in range(4)]
    for n in range(1, 5):
        done = run_incremental(spark, "s", source(spark, *rows[:n]), "lastmodified", landing, AS_OF)
        assert done.rows == 1
    df = source(spark, *rows)
    read = []

    def spy(spark, name, landing, schema, batches):
        read.extend(batches)
        return incremental_job_read(spark, name, landing, schema, batches)

    incremental_job_read = incremental_job.read_batches
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(incremental_job, "read_batches", spy)
        assert run_incremental(spark, "s", df, "lastmodified", landing, AS_OF, overlap=timedelta(seconds=90)).rows == 0
    assert [b[:8] for b in read] == ["00000002", "00000003"]
    # Logs without zone maps are read in full.
    log = landing.log(spark).drop("least", "greatest").collect()
    schema = incremental_job.LOG_SCHEMA
    spark.createDataFrame([(*r, None, None) for r in log], schema).write.mode("overwrite").parquet(f"{tmp_path}/old/bookmarks")
    assert len(incremental_job.batches_since(spark, "s", Landing(f"{tmp_path}/old"), df.schema["lastmodified"].dataType, at(3))) == 4


def test_rows_without_a_change_time_are_set_aside_once(spark, tmp_path):
    landing, twice = Landing(str(tmp_path)), ("C8", "Pune", None, None)
    first = source(spark, *INSERTS, ("C9", "Goa", False, None), twice, twice)
    more = source(spark, *INSERTS, ("C9", "Goa", False, None), ("C7", "new", False, None), twice, twice)
    load = lambda df: run_incremental(spark, "s", df, "lastmodified", landing, AS_OF, quarantine=True)
    assert [load(df).quarantined for df in (first, first, more, more)] == [3, 0, 1, 0]
    aside = read_files(spark, landing.quarantine("s"), schema=first.schema)
    assert sorted(r.customer_id for r in aside.collect()) == ["C7", "C8", "C8", "C9"]


def test_a_change_in_a_map_is_news(spark, tmp_path):
    landing, schema = Landing(str(tmp_path)), "id int, m map<string,int>, ts timestamp_ntz"

    def load(m):
        df = spark.createDataFrame([(1, m, at(0))], schema)
        return run_incremental(spark, "s", df, "ts", landing, AS_OF, overlap=timedelta(seconds=1)).rows

    assert [load(m) for m in ({"a": 1, "b": 2}, {"b": 2, "a": 1}, {"a": 1, "b": 3}, None, None)] == [1, 0, 1, 1, 0]


@pytest.mark.parametrize(
    "kind, value, mark, last",
    [
        ("bigint", 7, "7", None),
        ("decimal(10,2)", Decimal("7.50"), "7.50", None),
        ("date", datetime(2024, 1, 5).date(), "2024-01-05", datetime(2024, 1, 5)),
        ("timestamp_ntz", datetime(2024, 1, 5, 1, 2, 3), "2024-01-05T01:02:03", datetime(2024, 1, 5, 1, 2, 3)),
    ],
)
def test_bookmarks_can_be_read_for_every_type(spark, tmp_path, kind, value, mark, last):
    landing = Landing(str(tmp_path))
    run_incremental(spark, "s", spark.createDataFrame([(1, value)], f"id int, c {kind}"), "c", landing, AS_OF)
    row = landing.bookmarks(spark).first()
    assert (row.table_name, row.mark, row.last_value) == ("s", mark, last)


SIDE = "k int, v string, m map<string,int>, ts timestamp_ntz"


@pytest.mark.parametrize("levels", [1, 3])
def test_unstamped_changes(spark, levels):
    same = [(i, f"v{i}", {"a": i}, at(0)) for i in range(300)]
    source_rows = [*same, (1000, "x", None, at(0)), (1001, "new", None, at(1)), (1002, "x", {"a": 2}, at(0)), (1004, None, None, None)]
    copy_rows = [*same, (1000, "old", None, at(0)), (1001, "x", None, at(0)), (1002, "x", {"a": 1}, at(0)), (1003, "x", None, at(0)), (1004, "x", None, None)]
    left, right = (spark.createDataFrame(r, SIDE).repartition(3) for r in (source_rows, copy_rows))
    found = digests.unstamped_changes(left, right, ["k"], "ts", levels)
    assert {tuple(r) for r in found.collect()} == {
        (1000, "unstamped"), (1001, "unloaded"), (1002, "unstamped"), (1003, "gone"), (1004, "unstamped"),
    }
    assert digests.differing_ranges(left, left.repartition(7), ["k"], levels) == []
    assert {r.finding for r in digests.unstamped_changes(left, right.limit(0), ["k"], "ts", levels).collect()} == {"unloaded"}
