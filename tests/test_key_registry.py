"""Colliding hashed keys: forced short keys, reloads, and stars that publish with them."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from tidemark.operators.key_registry import Keys, extended
from tidemark.plans.star_load import build_star, publish_star, read_star, registered_keys

AT = datetime(2024, 1, 1)
ATTRIBUTES = ["first_name", "last_name", "city", "state"], ["product_name", "category_id", "category_name", "list_price", "is_active"]


def names(spark, values):
    return spark.createDataFrame([(str(v),) for v in values], "natural string")


def keys_of(spark, values, registry, digits=2):
    df = names(spark, values)
    rows = Keys(digits, {"natural": registry}).add(df, "natural", "key").collect()
    return {r.natural: r.key for r in rows}


def test_keys_are_unique_and_stay(spark):
    first = extended(names(spark, [*range(100), 7, 7]), None, None, 2)
    before = keys_of(spark, range(100), first)
    assert len(set(before.values())) == 100 and any(k < 0 for k in before.values())
    stored = spark.createDataFrame(list(before.items()), "natural string, key long")
    second = extended(names(spark, reversed(range(300))), first, stored, 2)
    after = keys_of(spark, range(300), second)
    assert len(set(after.values())) == 300 and {n: after[n] for n in before} == before
    # Naturals that are gone keep their keys for the day they come back.
    third = extended(names(spark, range(150, 300)), second, None, 2)
    assert keys_of(spark, range(300), third) == after
    assert extended(names(spark, range(100)), None, None).isEmpty()


def model(spark, n):
    customers = spark.createDataFrame([(i, f"f{i}", "l", "c", "s") for i in range(n)], "customer_id long, first_name string, last_name string, city string, state string")
    categories = spark.createDataFrame([(1, "cat")], "category_id long, category_name string")
    products = spark.createDataFrame([(i, f"p{i}", 1, Decimal(1), 1) for i in range(n)], "product_id long, product_name string, category_id long, list_price decimal(10,2), is_active int")
    orders = spark.createDataFrame([(i, i, AT, "F") for i in range(n)], "order_id long, customer_id long, order_ts timestamp_ntz, order_status string")
    items = spark.createDataFrame([(i, 1, i, 1, Decimal(5), None) for i in range(n)], "order_id long, line_number int, product_id long, quantity int, unit_price decimal(10,2), discount_amount decimal(10,2)")
    return customers, categories, products, orders, items


def test_a_star_with_colliding_keys_is_published(spark, tmp_path):
    root, seen = str(tmp_path), {}
    with pytest.raises(ValueError, match="collide"):
        publish_star(build_star(*model(spark, 40), *ATTRIBUTES, keys=Keys(2)), root, "r0", AT)
    for release, n in (("r1", 40), ("r2", 60)):
        tables = model(spark, n)
        keys = registered_keys(spark, root, {"customer_id": tables[0], "product_id": tables[2]}, digits=2)
        report = publish_star(build_star(*tables, *ATTRIBUTES, keys=keys), root, release, AT, keys=keys)
        assert set(report.orphan_rows.values()) == {0}
        star = read_star(spark, root)
        found = {(r.customer_id, r.customer_key) for r in star.dim_customer.select("customer_id", "customer_key").collect()}
        assert len({k for _, k in found}) == n and seen.get("customers", set()) <= found
        seen["customers"] = found
        lines = star.fact_sales.join(star.dim_customer, "customer_key").join(star.dim_product, "product_key")
        assert lines.filter("order_id = customer_id AND order_id = product_id").count() == n
