"""Relational building blocks, one query per operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.latest import latest_per_key, newest_versions
from tidemark.operators.numbering import number_rows
from tidemark.operators.revenue import best_first, net_amount, order_lines, order_totals
from tidemark.operators.union import align, stack
from tidemark.operators.update import update_where
from tidemark.queries import fixture as fx
from tidemark.queries.fixture import (
    BATCH_KEYS,
    MOVED_SQL,
    NET_SQL,
    RUNS_SQL,
    SCD2,
    as_float,
    key_sql,
    table,
)
from tidemark.queries.registry import query
from tidemark.session import scratch_path

RUN_COLUMNS = "customer_id, order_id, order_status, order_priority, last_modified_ts"



@query(
    "project_cast_alias",
    """SELECT o_orderkey AS order_id, cast(o_custkey AS int) AS customer_id,
       o_orderstatus AS order_status,
       cast(cast(o_totalprice AS decimal(10,2)) AS varchar) AS order_total
FROM orders""",
)
def project_cast_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").cast("decimal(10,2)").cast("string").alias("order_total"),
    )


@query("filter_status", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def filter_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")


@query(
    "conditional_update",
    """SELECT o_orderkey, CASE WHEN o_custkey = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_custkey = 7 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
)
def conditional_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``UPDATE … WHERE key = literal`` as a projection over the whole table."""
    updated = update_where(
        table(spark, sf_dir, "orders"),
        F.col("o_custkey") == 7,
        {"o_orderstatus": F.lit("X"), "o_orderpriority": F.lit("1-URGENT")},
    )
    return updated.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "join_inner_fact",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id,
       o_orderdate AS order_ts, o_orderstatus AS order_status, cast(l_quantity AS int) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fx.items(spark, sf_dir)
        .join(fx.orders(spark, sf_dir), "order_id")
        .select("order_id", "line_number", "customer_id", "order_ts", "order_status", "quantity")
    )


@query(
    "join_semi_changed",
    f"""{RUNS_SQL}
SELECT {RUN_COLUMNS} FROM run2 WHERE customer_id IN (
    SELECT customer_id FROM run1 a JOIN run2 b USING (customer_id) WHERE {MOVED_SQL})""",
)
def join_semi_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rows of the changed keys: a join that only filters is a semi join."""
    incoming = fx.run2(spark, sf_dir)
    dim = SCD2.initial(fx.run1(spark, sf_dir))
    changed = SCD2.changed_keys(SCD2.changes(dim, incoming))
    return incoming.join(changed, BATCH_KEYS, "left_semi")


@query(
    "join_left_denorm",
    f"""SELECT p_partkey AS product_id, p_name AS product_name,
       {key_sql("p_type")} AS category_id, p_type AS category_name
FROM part""",
)
def join_left_denorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fx.products(spark, sf_dir)
        .join(fx.categories(spark, sf_dir), "category_id", "left")
        .select("product_id", "product_name", "category_id", "category_name")
    )


@query(
    "join_anti_new_keys",
    f"""{RUNS_SQL}
SELECT {RUN_COLUMNS} FROM run2 WHERE customer_id NOT IN (SELECT customer_id FROM run1)""",
)
def join_anti_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.run2(spark, sf_dir).join(fx.run1(spark, sf_dir), BATCH_KEYS, "left_anti")


@query(
    "join_left_isnull_anti",
    f"""{RUNS_SQL}, dim AS (SELECT *, true AS is_current FROM run1)
SELECT c_custkey AS customer_id, c_name
FROM customer LEFT JOIN dim ON c_custkey = dim.customer_id AND dim.is_current
WHERE dim.customer_id IS NULL""",
)
def join_left_isnull_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a current row in the dimension."""
    current = SCD2.current_view(SCD2.initial(fx.run1(spark, sf_dir)))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name"
    )
    return customers.join(current, "customer_id", "left_anti")


@query(
    "join_full_merge",
    f"""{RUNS_SQL}
SELECT coalesce(b.customer_id, a.customer_id) AS customer_id, a.order_status AS old_status,
       b.order_status AS new_status, coalesce(b.order_status, a.order_status) AS merged_status
FROM run1 a FULL JOIN run2 b ON a.customer_id = b.customer_id""",
)
def join_full_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full outer join of two frames with one row per key."""
    old = fx.run1(spark, sf_dir).select("customer_id", F.col("order_status").alias("old_status"))
    new = fx.run2(spark, sf_dir).select("customer_id", F.col("order_status").alias("new_status"))
    return new.join(old, "customer_id", "full").select(
        "customer_id",
        "old_status",
        "new_status",
        F.coalesce("new_status", "old_status").alias("merged_status"),
    )


@query(
    "join_2way",
    f"""SELECT o_orderpriority AS order_priority, count(*) AS line_count,
       cast(sum({NET_SQL}) AS double) AS net_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def join_2way(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("order_priority")
    )
    return (
        order_totals(fx.items(spark, sf_dir))
        .join(headers, "order_id")
        .groupBy("order_priority")
        .agg(F.sum("line_count").alias("line_count"), F.sum("net_amount").alias("net_revenue"))
        .withColumns(as_float("net_revenue"))
    )


@query(
    "join_4way",
    f"""SELECT o_orderstatus AS order_status, p_type AS category_name, count(*) AS line_count,
       cast(sum({NET_SQL}) AS double) AS net_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2""",
)
def join_4way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, lines, products and categories; lines are summed per product before the lookup."""
    lines = order_lines(fx.items(spark, sf_dir), fx.orders(spark, sf_dir), status=None)
    per_product = lines.groupBy("product_id", "order_status").agg(
        F.count("*").alias("line_count"), F.sum("net_amount").alias("net_amount")
    )
    return (
        per_product.join(fx.product_categories(spark, sf_dir), "product_id")
        .groupBy("order_status", "category_name")
        .agg(F.sum("line_count").alias("line_count"), F.sum("net_amount").alias("net_revenue"))
        .withColumns(as_float("net_revenue"))
    )


@query(
    "join_5way",
    f"""SELECT n_name AS city, p_type AS category_name, o_orderstatus AS order_status,
       count(*) AS line_count, cast(sum({NET_SQL}) AS double) AS net_revenue
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2, 3""",
)
def join_5way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``join_4way`` plus customers, who are met with one row per category and status."""
    lines = order_lines(fx.items(spark, sf_dir), fx.orders(spark, sf_dir), status=None)
    groups = ["category_name", "order_status"]
    per_customer = (
        lines.join(fx.product_categories(spark, sf_dir), "product_id")
        .groupBy("customer_id", *groups)
        .agg(F.count("*").alias("line_count"), F.sum("net_amount").alias("net_amount"))
    )
    return (
        per_customer.join(fx.customers(spark, sf_dir), "customer_id")
        .groupBy("city", *groups)
        .agg(F.sum("line_count").alias("line_count"), F.sum("net_amount").alias("net_revenue"))
        .withColumns(as_float("net_revenue"))
    )


@query("agg_global_max", "SELECT max(o_orderdate) AS max_ts FROM orders")
def agg_global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("max_ts"))


@query(
    "agg_min_max",
    """SELECT min(cast(ts AS date)) AS min_date, max(cast(ts AS date)) AS max_date FROM events""",
)
def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("ts")
    return table(spark, sf_dir, "events").agg(
        F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )


@query(
    "agg_group_sum",
    """SELECT o_orderstatus AS order_status,
       cast(sum(cast(o_totalprice AS decimal(10,2))) AS double) AS order_total
FROM orders GROUP BY 1""",
)
def agg_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = fx.orders(spark, sf_dir).groupBy("order_status")
    return grouped.agg(F.sum("order_total").alias("order_total")).withColumns(
        as_float("order_total")
    )


@query(
    "agg_sum_expr",
    f"""SELECT l_returnflag AS return_flag, cast(sum({NET_SQL}) AS double) AS net_revenue
FROM lineitem GROUP BY 1""",
)
def agg_sum_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = fx.cents("l_extendedprice")
    discount = (price * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(10,2)")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        discount.alias("discount_amount"),
    )
    return (
        lines.groupBy("return_flag")
        .agg(F.sum(net_amount()).alias("net_revenue"))
        .withColumns(as_float("net_revenue"))
    )


@query(
    "agg_group_2keys",
    """SELECT l_returnflag, l_linestatus, sum(cast(l_quantity AS bigint)) AS quantity
FROM lineitem GROUP BY 1, 2""",
)
def agg_group_2keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    total = F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    return lines.groupBy("l_returnflag", "l_linestatus").agg(total)


@query(
    "agg_group_expr",
    """SELECT cast(ts AS date) AS full_date, count(*) AS event_count,
       cast(sum(cast(value AS decimal(12,2))) AS double) AS value_total
FROM events GROUP BY 1""",
)
def agg_group_expr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("full_date"))
        .agg(
            F.count("*").alias("event_count"),
            F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("value_total"),
        )
    )


@query(
    "agg_group_count",
    "SELECT user_id, event_type, count(*) AS event_count FROM events GROUP BY 1, 2",
)
def agg_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id", "event_type").agg(F.count("*").alias("event_count"))


@query("distinct_keys", "SELECT DISTINCT o_custkey AS customer_id FROM orders")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer_id")).distinct()


@query(
    "window_row_number",
    """SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders""",
)
def window_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of each customer, numbered from the newest."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return number_rows(orders, newest, "rn", scratch_path(spark, "window_row_number"), by=["o_custkey"])


@query(
    "window_newest_three",
    """SELECT o_custkey, o_orderkey, o_orderdate, rn FROM (
    SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn <= 3""",
)
def window_newest_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three newest orders of each customer, numbered: a top-k report."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return newest_versions(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], n=3)


@query(
    "latest_per_key",
    """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "sort_by_aggregate",
    """SELECT l_partkey AS product_id, sum(cast(l_quantity AS bigint)) AS quantity
FROM lineitem GROUP BY 1 ORDER BY quantity DESC, product_id""",
)
def sort_by_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fx.items(spark, sf_dir)
    sold = items.groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    return best_first(sold, "quantity")


@query(
    "union_by_name",
    f"""{RUNS_SQL}
SELECT {RUN_COLUMNS} FROM run1 UNION ALL SELECT {RUN_COLUMNS} FROM run2""",
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = fx.run1(spark, sf_dir), fx.run2(spark, sf_dir)
    reordered = second.select(*reversed(second.columns))
    return stack(first, align(reordered, first))
