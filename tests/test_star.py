"""Star schema and revenue on the seed model."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.seeds import model
from tidemark.functions import surrogate_key
from tidemark.operators.dimensions import dim_date
from tidemark.operators.fanout import fanout_report, fanout_totals, repeated_header_revenue
from tidemark.operators.quality import duplicate_grain, lines_per_order, orphans
from tidemark.operators.revenue import best_first, daily_revenue, order_lines, placed, revenue_by
from tidemark.plans.star_load import build_star, publish_star, read_star
from tidemark.sinks.releases import publish, read_current


@pytest.fixture(scope="module")
def seed(spark):
    return {name: df.cache() for name, df in model(spark).items()}


@pytest.fixture(scope="module")
def star(seed):
    return build_star(
        seed["customers"], seed["categories"], seed["products"], seed["orders"], seed["items"]
    )


def pairs(df, *keys, measure="net_revenue"):
    return {tuple(r[k] for k in keys): float(r[measure]) for r in df.collect()}


BY_CATEGORY = {("Electronics",): 78500, ("Accessories",): 18600, ("Home",): 4500}
BY_BOTH = {
    ("Mumbai", "Electronics"): 70000,
    ("Mumbai", "Accessories"): 11000,
    ("Bengaluru", "Electronics"): 8500,
    ("Delhi", "Home"): 4500,
    ("Pune", "Accessories"): 4100,
    ("Bengaluru", "Accessories"): 3500,
}
BY_DAY = {(date(2024, 2, 1),): 76500, (date(2024, 2, 3),): 16500, (date(2024, 2, 4),): 8600}


def test_revenue_by_category_agrees_in_both_forms(seed, star):
    products = seed["products"].join(seed["categories"], "category_id")
    lines = order_lines(seed["items"], seed["orders"])
    oltp = revenue_by(lines, [(products, "product_id")], ["category_name"])
    olap = revenue_by(placed(star.fact_sales), [(star.dim_product, "product_key")], ["category_name"])
    assert pairs(oltp, "category_name") == pairs(olap, "category_name") == BY_CATEGORY


def test_revenue_by_city_and_category_agrees_in_both_forms(seed, star):
    products = seed["products"].join(seed["categories"], "category_id")
    lines = order_lines(seed["items"], seed["orders"])
    group = ["city", "category_name"]
    oltp = revenue_by(
        lines, [(products, "product_id"), (seed["customers"], "customer_id")], group
    )
    olap = revenue_by(
        placed(star.fact_sales),
        [(star.dim_product, "product_key"), (star.dim_customer, "customer_key")],
        group,
    )
    assert pairs(oltp, *group) == pairs(olap, *group) == BY_BOTH


def test_daily_revenue_agrees_in_both_forms(seed, star):
    oltp = daily_revenue(seed["items"], seed["orders"])
    olap = revenue_by(placed(star.fact_sales), [(star.dim_date, "date_key")], ["full_date"])
    assert pairs(oltp, "full_date") == pairs(olap, "full_date") == BY_DAY


def test_revenue_by_city_is_sorted_best_first(star):
    report = best_first(
        revenue_by(placed(star.fact_sales), [(star.dim_customer, "customer_key")], ["city"])
    )
    assert [(r.city, float(r.net_revenue)) for r in report.collect()] == [
        ("Mumbai", 81000),
        ("Bengaluru", 12000),
        ("Delhi", 4500),
        ("Pune", 4100),
    ]


def test_grouping_by_a_column_of_the_lines(seed):
    products = seed["products"].join(seed["categories"], "category_id")
    lines = order_lines(seed["items"], seed["orders"], status=None)
    got = revenue_by(lines, [(products, "product_id")], ["category_name", "order_status"])
    assert pairs(got, "category_name", "order_status")[("Accessories", "CANCELLED")] == 800


def test_fanout(seed):
    products = seed["products"].join(seed["categories"], "category_id")
    wrong = repeated_header_revenue(seed["items"], seed["orders"], products, "category_name")
    assert pairs(wrong, "category_name", measure="wrong_revenue_using_order_total") == {
        ("Accessories",): 110700,
        ("Electronics",): 84900,
        ("Home",): 4500,
    }
    totals = fanout_totals(seed["items"], seed["orders"]).first()
    assert [float(v) for v in totals] == [101600, 200100]
    headers = placed(seed["orders"])
    report = fanout_report(headers, seed["items"], "order_id", "order_total")
    assert {r.order_id: r.line_count for r in report.collect()} == {
        1001: 2,
        1002: 2,
        1004: 2,
        1005: 1,
        1006: 2,
    }


def test_fact_grain_and_measures(star):
    fact = star.fact_sales
    assert fact.count() == 10
    assert duplicate_grain(fact, ["order_id", "line_number"]).count() == 0
    assert {r.order_id: r.line_count for r in lines_per_order(fact).collect()}[1003] == 1
    total = placed(fact).agg(F.sum("net_amount")).first()[0]
    assert float(total) == 101600
    assert dict(fact.dtypes)["net_amount"] == "decimal(10,2)"
    for dim, key in [
        (star.dim_customer, "customer_key"),
        (star.dim_product, "product_key"),
        (star.dim_date, "date_key"),
    ]:
        assert orphans(fact, dim, key, key).count() == 0


def test_defaults_and_unknown_categories(seed, star):
    active = {r.product_id: r.is_active for r in star.dim_product.collect()}
    assert active[105] == 1
    fewer = seed["categories"].filter("category_id <> 30")
    s = build_star(seed["customers"], fewer, seed["products"], seed["orders"], seed["items"])
    names = {r.product_id: r.category_name for r in s.dim_product.collect()}
    assert names[104] is None and len(names) == 5


def test_surrogate_key_fits_and_is_unique(spark):
    keys = spark.range(200_000).select(surrogate_key(F.col("id")).alias("k"))
    row = keys.agg(F.count("k"), F.countDistinct("k"), F.min("k"), F.max("k")).first()
    assert row[0] == row[1] == 200_000
    assert 0 <= row[2] and row[3] < 2**60
    with pytest.raises(ValueError):
        surrogate_key(F.col("id"), digits=16)


def test_calendar(spark, seed):
    days = dim_date(seed["orders"], "order_ts").orderBy("date_key").collect()
    assert [d.date_key for d in days] == [20240201, 20240202, 20240203, 20240204]
    assert [d.day_name for d in days] == ["Thu", "Fri", "Sat", "Sun"]
    assert [d.day_of_week for d in days] == [5, 6, 7, 1]
    iso = dim_date(seed["orders"], "order_ts", iso=True).orderBy("date_key").collect()
    assert [d.day_of_week for d in iso] == [4, 5, 6, 7]
    assert dim_date(seed["orders"].limit(0), "order_ts").count() == 0


def test_calendar_does_not_depend_on_the_session_time_zone(spark, seed):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = dim_date(seed["orders"], "order_ts").orderBy("date_key").collect()
        assert [(d.date_key, d.day_name) for d in days][0] == (20240201, "Thu")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_star_is_published_as_one_release(spark, star, tmp_path):
    root = str(tmp_path)
    publish_star(star, root, "r1", datetime(2024, 1, 1))
    stored = read_star(spark, root)
    for name, df in star.tables().items():
        kept = stored.tables()[name]
        assert kept.columns == df.columns
        assert kept.exceptAll(df).isEmpty() and df.exceptAll(kept).isEmpty()


def test_release_switch(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(LookupError):
        read_current(spark, root, "t")
    publish({"t": spark.range(3)}, root, "r1", datetime(2024, 1, 1))
    (reader,) = read_current(spark, root, "t")
    publish({"t": reader.filter("id > 0")}, root, "r2", datetime(2024, 1, 2))
    assert reader.count() == 3
    assert read_current(spark, root, "t")[0].count() == 2
    with pytest.raises(ValueError, match="already published"):
        publish({"t": spark.range(1)}, root, "r2", datetime(2024, 1, 3))


def test_unannounced_release_is_invisible(spark, tmp_path):
    root = str(tmp_path)
    publish({"t": spark.range(3)}, root, "r1", datetime(2024, 1, 1))
    spark.range(99).write.parquet(f"{root}/data/release=r2/t")
    assert read_current(spark, root, "t")[0].count() == 3
    publish({"t": spark.range(5)}, root, "r2", datetime(2024, 1, 2))
    assert read_current(spark, root, "t")[0].count() == 5
