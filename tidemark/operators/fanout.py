"""Fan-out diagnostics: what a header measure becomes when it is repeated on every line."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.revenue import PLACED, order_totals, revenue_by


def fanout_report(headers: DataFrame, lines: DataFrame, key: str, measure: str) -> DataFrame:
    """Per header: its measure and how many times a join to the lines repeats it."""
    per_header = lines.groupBy(key).agg(F.count("*").alias("line_count"))
    return headers.select(key, measure).join(per_header, key)


def fanout_totals(items: DataFrame, orders: DataFrame, status: str = PLACED) -> DataFrame:
    """One row: the correct line-level total beside the inflated header total.

    Both come from one pass over the lines, summed per order before the join.
    """
    headers = orders.filter(F.col("order_status") == status).select("order_id", "order_total")
    return (
        order_totals(items)
        .join(headers, "order_id")
        .agg(
            F.sum("net_amount").alias("correct_line_level_total"),
            F.sum(F.col("order_total") * F.col("line_count")).alias("wrong_repeated_order_total"),
        )
    )


def repeated_header_revenue(
    items: DataFrame, orders: DataFrame, products: DataFrame, group_col: str, status: str = PLACED
) -> DataFrame:
    """The wrong revenue per product attribute that repeating ``order_total`` yields."""
    headers = orders.filter(F.col("order_status") == status).select("order_id", "order_total")
    repeated = items.select("order_id", "product_id").join(headers, "order_id")
    return revenue_by(
        repeated,
        [(products, "product_id")],
        [group_col],
        measure="order_total",
        result="wrong_revenue_using_order_total",
    )
