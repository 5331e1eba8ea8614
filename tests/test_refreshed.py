"""A fact refreshed by months, the landed state kept beside its batches, and equal splits."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators.facts import fact_sales
from tidemark.plans import landed_state
from tidemark.plans.fact_refresh import MONTH, read_fact, refresh_fact
from tidemark.plans.incremental_job import Landing, run_incremental
from tidemark.plans.landed_state import current_state
from tidemark.sources.jdbc import equi_depth_predicates

AT = datetime(2024, 1, 1)


def lines(spark, *rows):
    schema = "order_id long, line_number int, product_id long, quantity int, unit_price decimal(10,2), discount_amount decimal(10,2)"
    return spark.createDataFrame([(o, n, 1, q, Decimal(5), None) for o, n, q in rows], schema)


def headers(spark, *rows):
    schema = "order_id long, customer_id long, order_ts timestamp_ntz, order_status string"
    return spark.createDataFrame([(o, 7, ts, s) for o, ts, s in rows], schema)


def test_a_fact_is_refreshed_by_months(spark, tmp_path):
    root, day = str(tmp_path), lambda m: datetime(2024, m, 3)
    orders = [(1, day(1), "F"), (2, day(2), "F"), (3, day(3), "F"), (4, day(4), "F"), (5, None, "F")]
    items = [(o, n, 2) for o in range(1, 6) for n in (1, 2)]
    refresh_fact(lines(spark, *items), headers(spark, *orders), root, "r1", AT)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "data").rglob("*.parquet")}
    before = files()
    # Order 2 moves to June, 3 loses a line, 4 goes, 6 is new; January stays.
    orders = [(1, day(1), "F"), (2, day(6), "P"), (3, day(3), "F"), (5, None, "F"), (6, day(3), "F")]
    items = [i for i in items if i[:2] != (3, 2) and i[0] != 4] + [(6, 1, 9)]
    changed = spark.createDataFrame([(2,), (3,), (4,), (6,), (6,)], "order_id long")
    new = lines(spark, *items), headers(spark, *orders)
    assert refresh_fact(*new, root, "r2", AT, changed) == [202402, 202403, 202404, 202406]
    after = files()
    months = lambda paths: {p.parent.name.split("=")[1] for p in paths}
    assert months(set(before) & set(after)) == {"202401", "0"} and months(after) == {"202401", "202403", "202406", "0"}
    got, want = read_fact(spark, root).drop(MONTH), fact_sales(*new)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))
    assert refresh_fact(*new, root, "r3", AT, changed.limit(0)) == []


def test_the_state_reads_new_batches_only(spark, tmp_path, monkeypatch):
    landing, read = Landing(str(tmp_path)), []
    plain = landed_state.read_batches
    monkeypatch.setattr(landed_state, "read_batches", lambda *a: read.append(a[-1]) or plain(*a))
    schema = "k int, v string, ts timestamp_ntz"

    def state(*rows):
        df = spark.createDataFrame(list(rows), schema)
        if rows:
            run_incremental(spark, "s", df, "ts", landing, AT + timedelta(days=9))
        found = current_state(spark, "s", landing, df.schema, ["k"], ["ts"], AT, buckets=4)
        return sorted(tuple(r)[:2] for r in found.collect())

    at = lambda n: AT + timedelta(hours=n)
    assert state() == [] and read == []
    assert state((1, "a", at(1)), (1, "b", at(2)), (2, "x", at(1))) == [(1, "b"), (2, "x")]
    assert state((3, "n", at(3)), (1, "c", at(4))) == [(1, "c"), (2, "x"), (3, "n")]
    assert state() == [(1, "c"), (2, "x"), (3, "n")]
    assert [len(batches) for batches in read] == [1, 1]


VALUES = {
    "long": [7] * 400 + list(range(800)),
    "double": [0.5] * 300 + [i / 7 for i in range(600)],
    "date": [date(2024, 1, 1) + timedelta(days=i % 300) for i in range(900)],
    "timestamp_ntz": [datetime(2024, 1, 1) + timedelta(seconds=i * i, microseconds=i) for i in range(900)],
}


@pytest.mark.parametrize("kind", VALUES)
def test_equal_splits_are_disjoint_and_complete(spark, kind):
    values = [*VALUES[kind], *[None] * 50]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    conditions = equi_depth_predicates(df, "k", 10)
    met = [F.coalesce(F.expr(c).cast("int"), F.lit(0)) for c in conditions]
    rows = df.select(F.array(*met).alias("met"), "k").collect()
    assert all(sum(r.met) == 1 for r in rows)
    sizes = [sum(r.met[i] for r in rows if r.k not in (7, 0.5)) for i in range(len(conditions))]
    assert len(conditions) >= 7 and max(sizes) < 2.5 * len(values) / 10
    assert len(equi_depth_predicates(df.limit(0), "k", 10)) == len(equi_depth_predicates(df, "k", 1)) == 1
