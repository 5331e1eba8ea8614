"""Revenue questions, on the normalized tables and on the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import line_net

PLACED = "PLACED"


def revenue_by(
    lines: DataFrame,
    dims: list[tuple[DataFrame, str]],
    group_cols: list[str],
    measure: str = "net_amount",
    result: str = "net_revenue",
) -> DataFrame:
    """Sum ``measure`` by attributes of the dimensions, joined one after another.

    Before the last join the measure is summed per remaining key and attributes gathered
    so far. That join then sees one row per key and attribute value instead of one per
    line, so a hot customer or product costs no more than any other, whether the
    dimension is broadcast or shuffled. Which of the two happens is left to Spark's size
    check. An earlier join still has line grain and relies on the adaptive skew join; put
    the dimension with the fewest distinct attribute values first.
    """
    keys = [key for _, key in dims]
    gathered = [c for c in group_cols if c in lines.columns and c not in keys]
    rows = lines.select(*keys, *gathered, measure)
    for place, (dim, key) in enumerate(dims):
        if place == len(dims) - 1:
            rows = rows.groupBy(key, *gathered).agg(F.sum(measure).alias(measure))
        attributes = [c for c in group_cols if c in dim.columns and c not in gathered]
        rows = rows.join(dim.select(key, *attributes), key)
        gathered += attributes
    return rows.groupBy(*group_cols).agg(F.sum(measure).alias(result))


def net_amount() -> Column:
    return line_net(F.col("quantity"), F.col("unit_price"), F.col("discount_amount"))


def order_lines(items: DataFrame, orders: DataFrame, status: str | None = PLACED) -> DataFrame:
    """Lines with their order's customer, time and net amount."""
    headers = orders if status is None else orders.filter(F.col("order_status") == status)
    return items.join(headers, "order_id").select(
        "order_id",
        "customer_id",
        "product_id",
        "order_ts",
        "order_status",
        net_amount().alias("net_amount"),
    )


def order_totals(items: DataFrame) -> DataFrame:
    """Net amount and number of lines per order."""
    return items.groupBy("order_id").agg(
        F.sum(net_amount()).alias("net_amount"), F.count("*").alias("line_count")
    )


def daily_revenue(items: DataFrame, orders: DataFrame, status: str = PLACED) -> DataFrame:
    """Net revenue per day, from lines summed per order before they meet the header."""
    headers = orders.filter(F.col("order_status") == status)
    return (
        order_totals(items)
        .join(headers, "order_id")
        .groupBy(F.to_date("order_ts").alias("full_date"))
        .agg(F.sum("net_amount").alias("net_revenue"))
    )


def placed(fact: DataFrame, status: str = PLACED) -> DataFrame:
    return fact.filter(F.col("order_status") == status)


def best_first(report: DataFrame, measure: str = "net_revenue") -> DataFrame:
    """Largest measure first; equal measures in the order of the other columns."""
    others = [c for c in report.columns if c != measure]
    return report.orderBy(F.col(measure).desc(), *others)
