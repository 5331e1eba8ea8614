"""Fact builder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import date_key, line_gross, line_net
from tidemark.functions.money import MONEY
from tidemark.operators.key_registry import Keys


def fact_sales(items: DataFrame, orders: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """One row per order line, with hashed dimension keys and exact measures.

    A line takes its hashed key after the join, since the shuffle packs small product ids
    better than hashes.

    The only join is lines to headers. The dimension keys are computed, not looked up;
    what depends on the header alone is computed before the join, once per order. A
    header with very many lines is left to the adaptive skew join: no step after the join
    depends on its partitioning, so Spark is free to split such a partition. Only with a
    registry of colliding keys in ``keys`` does the fact meet that registry.
    """
    headers = keys.add(orders, "customer_id", "customer_key").select(
        "order_id",
        "customer_key",
        date_key(F.to_date("order_ts")).alias("date_key"),
        "order_status",
    )
    quantity = F.col("quantity").cast("int")
    price = F.col("unit_price").cast(MONEY)
    discount = F.coalesce(F.col("discount_amount").cast(MONEY), F.lit(0).cast(MONEY))
    lines = keys.add(items.join(headers, "order_id"), "product_id", "product_key")
    return lines.select(
        "order_id",
        F.col("line_number").cast("int").alias("line_number"),
        "customer_key",
        "product_key",
        "date_key",
        "order_status",
        quantity.alias("quantity"),
        price.alias("unit_price"),
        discount.alias("discount_amount"),
        line_gross(quantity, price).cast(MONEY).alias("gross_amount"),
        line_net(quantity, price, discount).cast(MONEY).alias("net_amount"),
    )
