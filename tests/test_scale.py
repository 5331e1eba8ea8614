"""Plans and skew: what must hold when the data no longer fits one task."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.seeds import TRACKED, batch
from tidemark.operators.facts import fact_sales
from tidemark.operators.incremental import incremental_slice
from tidemark.operators.latest import latest_per_key, newest_versions
from tidemark.operators.quality import orphans
from tidemark.operators.revenue import daily_revenue, order_lines, revenue_by
from tidemark.operators.scd1 import scd1_merge
from tidemark.operators.scd2 import Scd2
from tidemark.operators.scd3 import scd3_initial, scd3_merge

SF_DIR = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.fixture
def no_broadcast(spark):
    """Sizes as on a cluster: no side of a join is small enough to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


# The optional corpus queries may run Python where their operator needs it.
@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan


def hot_rows(count: int = 3000):
    """Change rows of which a third belong to one key."""
    rng = random.Random(7)
    return [
        (
            "HOT" if i % 3 == 0 else f"K{rng.randrange(200):03d}",
            "f",
            "l",
            "e",
            rng.choice(["Pune", "Goa", None]),
            rng.choice("12"),
            True,
            START + timedelta(seconds=i),
        )
        for i in range(count)
    ]


def stored_batch(spark, tmp_path, rows, name="batch"):
    path = str(tmp_path / name)
    batch(spark, rows).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def test_latest_per_key_reduces_before_its_only_shuffle(spark, tmp_path):
    rows = hot_rows()
    df = stored_batch(spark, tmp_path, rows)
    latest = latest_per_key(df, ["customer_id"], ["last_modified_ts"])
    plan = plan_of(latest)
    assert len(shuffles(plan)) == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max_by")
    want = {r[0]: r[7] for r in rows}
    assert {r.customer_id: r.last_modified_ts for r in latest.collect()} == want


def test_numbered_versions_are_limited_before_the_shuffle(spark, tmp_path):
    rows = hot_rows()
    df = stored_batch(spark, tmp_path, rows)
    newest = newest_versions(df, ["customer_id"], ["last_modified_ts"], n=2)
    plan = plan_of(newest)
    assert plan.count("WindowGroupLimit") == 2
    assert sorted(
        (r.rn, r.last_modified_ts) for r in newest.filter("customer_id = 'HOT'").collect()
    ) == [(1, rows[2997][7]), (2, rows[2994][7])]


def test_merges_need_one_shuffle(spark, tmp_path):
    dim_rows = stored_batch(spark, tmp_path, hot_rows(60)[:1], "dim")
    incoming = stored_batch(spark, tmp_path, hot_rows())
    keys, order = ["customer_id"], ["last_modified_ts"]
    scd = Scd2(keys, TRACKED, "last_modified_ts")
    merges = {
        "scd1": scd1_merge(dim_rows, incoming, keys, order),
        "scd2": scd.merge(scd.initial(dim_rows), incoming),
        "scd3": scd3_merge(scd3_initial(dim_rows, "city"), incoming, keys, "city", order),
    }
    for name, merged in merges.items():
        plan = plan_of(merged)
        assert len(shuffles(plan)) == 1, name
        assert "Join" not in plan, name
        assert "partial_max_by" in plan, name


def test_hot_key_in_a_merge(spark, tmp_path):
    rows = hot_rows()
    incoming = stored_batch(spark, tmp_path, rows)
    scd = Scd2(["customer_id"], TRACKED, "last_modified_ts")
    first = START - timedelta(days=1)
    dim = scd.initial(batch(spark, [("HOT", "f", "l", "e", "Nashik", "1", True, first)]))
    merged = scd.merge(dim, incoming).filter("customer_id = 'HOT'")
    assert sorted((r.version, r.effective_from, r.is_current) for r in merged.collect()) == [
        (1, first, False),
        (2, rows[2997][7], True),
    ]


def skewed_sales(spark, tmp_path, lines=6000):
    """Lines of which a third belong to one order and another third to one product."""
    rng = random.Random(11)
    rows = [
        (
            0 if i % 3 == 0 else rng.randrange(1, 400),
            i,
            0 if i % 3 == 1 else rng.randrange(1, 100),
            rng.randrange(1, 9),
            Decimal(rng.randrange(100, 99999)) / 100,
            Decimal(rng.randrange(0, 100)) / 100,
        )
        for i in range(lines)
    ]
    schema = (
        "order_id long, line_number int, product_id long, quantity int,"
        " unit_price decimal(10,2), discount_amount decimal(10,2)"
    )
    path = str(tmp_path / "items")
    spark.createDataFrame(rows, schema).repartition(12).write.parquet(path)
    orders = spark.range(400).select(
        F.col("id").alias("order_id"),
        (F.col("id") % 20).alias("customer_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(id % 9)")).alias("order_ts"),
        F.lit("PLACED").alias("order_status"),
        F.lit(10).cast("decimal(10,2)").alias("order_total"),
    )
    products = spark.range(100).select(
        F.col("id").alias("product_id"), F.concat(F.lit("cat "), F.col("id") % 4).alias("category")
    )
    for name, df in (("orders", orders), ("products", products)):
        df.write.parquet(str(tmp_path / name))
    return (rows, *[spark.read.parquet(str(tmp_path / n)) for n in ("items", "orders", "products")])


def test_sums_meet_the_product_dimension_reduced(spark, tmp_path, no_broadcast):
    rows, items, orders, products = skewed_sales(spark, tmp_path)
    report = revenue_by(order_lines(items, orders), [(products, "product_id")], ["category"])
    plan = plan_of(report)
    assert plan.count("SortMergeJoin") == 2
    assert sum("product_id" in keys for keys in shuffles(plan)) == 2
    want: dict[str, Decimal] = {}
    for _, _, product, quantity, price, discount in rows:
        name = f"cat {product % 4}"
        want[name] = want.get(name, Decimal(0)) + quantity * price - discount
    assert {r.category: r.net_revenue for r in report.collect()} == want


def test_daily_revenue_joins_one_row_per_order(spark, tmp_path, no_broadcast):
    rows, items, orders, _ = skewed_sales(spark, tmp_path)
    report = daily_revenue(items, orders)
    assert len(shuffles(plan_of(report))) == 3
    want: dict[int, Decimal] = {}
    for order, _, _, quantity, price, discount in rows:
        want[order % 9] = want.get(order % 9, Decimal(0)) + quantity * price - discount
    assert {r.full_date.day - 1: r.net_revenue for r in report.collect()} == want


def test_hot_order_is_split_by_the_adaptive_join(spark, tmp_path, no_broadcast):
    rows, items, orders, _ = skewed_sales(spark, tmp_path, lines=60_000)
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        fact = fact_sales(items, orders)
        assert len(fact.collect()) == len(rows)
        assert "skew=true" in plan_of(fact)
    finally:
        for key in small:
            spark.conf.unset(key)


def test_orphan_values_cross_the_join_once(spark, tmp_path, no_broadcast):
    _, items, orders, _ = skewed_sales(spark, tmp_path)
    kept = orders.filter("order_id <> 0")
    found = orphans(items, kept, "order_id", "order_id").collect()
    assert [(r.order_id, r.row_count) for r in found] == [(0, 2000)]


def test_slice_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    df = incremental_slice(orders, "o_orderdate", START, START + timedelta(days=9))
    plan = plan_of(df.select("o_orderkey", "o_orderdate"))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(o_orderdate.*LessThanOrEqual\(o_orderdate", plan)
    assert "struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_star_query_reads_three_columns_of_the_fact(spark):
    plan = plan_of(entry.queries()["revenue_by_category_star"](spark, SF_DIR))
    assert "ReadSchema: struct<product_key:bigint,order_status:string,net_amount:decimal(10,2)>" in plan
    assert "EqualTo(order_status,F)" in plan
