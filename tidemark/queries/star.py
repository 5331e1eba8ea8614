"""Star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.dimensions import dim_customer as customer_dimension
from tidemark.operators.dimensions import dim_date as calendar
from tidemark.operators.dimensions import dim_product as product_dimension
from tidemark.operators.facts import fact_sales as sales
from tidemark.operators.quality import duplicate_grain, lines_per_order, row_counts
from tidemark.plans.fact_refresh import MONTH, read_fact, refresh_fact
from tidemark.plans.star_load import publish_star, read_star
from tidemark.queries import fixture as fx
from tidemark.queries.fixture import AS_OF, as_float, key_sql
from tidemark.queries.registry import query
from tidemark.queries.revenue import star, stored_star
from tidemark.session import scratch_path


@query(
    "dim_customer",
    f"""
SELECT {key_sql("c_custkey")} AS customer_key, c_custkey AS customer_id,
       split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       n_name AS city, r_name AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
)
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_dimension(fx.customers(spark, sf_dir), fx.CUSTOMER_COLUMNS)


@query(
    "dim_product",
    f"""
SELECT {key_sql("p_partkey")} AS product_key, p_partkey AS product_id, p_name AS product_name,
       {key_sql("p_type")} AS category_id, p_type AS category_name,
       cast(cast(p_retailprice AS decimal(10,2)) AS double) AS list_price, 1 AS is_active
FROM part""",
)
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = product_dimension(
        fx.products(spark, sf_dir), fx.categories(spark, sf_dir), fx.PRODUCT_COLUMNS
    )
    return dim.withColumns(as_float("list_price"))


@query(
    "dim_date",
    """
SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, d AS full_date, year(d) AS year_num,
       month(d) AS month_num, day(d) AS day_num, dayofweek(d) + 1 AS day_of_week,
       strftime(d, '%a') AS day_name
FROM (SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
             AS date) AS d FROM orders)""",
)
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar(fx.orders(spark, sf_dir), "order_ts")


FACT_SQL = f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       {key_sql("o_custkey")} AS customer_key, {key_sql("l_partkey")} AS product_key,
       cast(strftime(o_orderdate, '%Y%m%d') AS int) AS date_key, o_orderstatus AS order_status,
       cast(l_quantity AS int) AS quantity,
       cast(price AS double) AS unit_price, cast(disc AS double) AS discount_amount,
       cast(cast(l_quantity AS int) * price AS double) AS gross_amount,
       cast(cast(l_quantity AS int) * price - disc AS double) AS net_amount
FROM (SELECT *, cast(l_extendedprice AS decimal(10,2)) AS price,
             cast(cast(l_extendedprice AS decimal(10,2)) * cast(l_discount AS decimal(4,2))
                  AS decimal(10,2)) AS disc
      FROM lineitem) JOIN orders ON l_orderkey = o_orderkey"""
MEASURES = ["unit_price", "discount_amount", "gross_amount", "net_amount"]


@query("fact_sales", FACT_SQL)
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = sales(fx.items(spark, sf_dir), fx.orders(spark, sf_dir))
    return fact.withColumns(as_float(*MEASURES))


@query("star_incremental", FACT_SQL)
def star_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of an earlier state of the orders, brought up to date by a change slice.

    Before the change, orders after the bookmark are missing and pending ones are dated
    earlier, so months gain, lose and change orders.
    """
    root = scratch_path(spark, "star_incremental")
    items, orders = fx.items(spark, sf_dir), fx.orders(spark, sf_dir)
    pending, later = F.col("order_status") == "P", F.col("order_ts") > F.lit(fx.BOOKMARK.isoformat(sep=" ")).cast("timestamp_ntz")
    earlier = F.when(pending, F.col("order_ts") - F.expr("INTERVAL 400 DAY")).otherwise(F.col("order_ts"))
    refresh_fact(items, orders.filter(~later).withColumn("order_ts", earlier), root, "r1", fx.BOOKMARK)
    refresh_fact(items, orders, root, "r2", AS_OF, changed=orders.filter(later | pending))
    return read_fact(spark, root).drop(MONTH).withColumns(as_float(*MEASURES))


@query(
    "publish_star",
    """
SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM customer
UNION ALL SELECT 'dim_product', count(*) FROM part
UNION ALL SELECT 'dim_date', date_diff('day', min(o_orderdate), max(o_orderdate)) + 1 FROM orders
UNION ALL SELECT 'fact_sales', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def publish_star_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the star to a fresh folder and count what can be read back."""
    root = scratch_path(spark, "publish_star")
    publish_star(star(spark, sf_dir), root, "r1", AS_OF)
    return row_counts(read_star(spark, root).tables())


@query(
    "grain_lines_per_order",
    """
SELECT l_orderkey AS order_id, count(*) AS line_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def grain_lines_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_per_order(stored_star(spark, sf_dir).fact_sales).orderBy("order_id")


@query(
    "having_dup_grain",
    """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS row_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def having_dup_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_grain(fx.items(spark, sf_dir), ["order_id", "line_number"])


@query(
    "star_join_1dim",
    f"""
SELECT l_orderkey AS order_id, l_linenumber AS line_number, p_name AS product_name,
       p_type AS category_name, cast(l_quantity AS int) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)
def star_join_1dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stored_star(spark, sf_dir)
    return s.fact_sales.join(s.dim_product, "product_key").select(
        "order_id", "line_number", "product_name", "category_name", "quantity"
    )


@query(
    "star_join_2dim",
    """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, n_name AS city,
       p_type AS category_name, cast(l_quantity AS int) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def star_join_2dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stored_star(spark, sf_dir)
    return (
        s.fact_sales.join(s.dim_product, "product_key")
        .join(s.dim_customer, "customer_key")
        .select("order_id", "line_number", "city", "category_name", "quantity")
    )


@query(
    "star_join_date",
    """
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       cast(o_orderdate AS date) AS full_date, strftime(o_orderdate, '%a') AS day_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def star_join_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stored_star(spark, sf_dir)
    return s.fact_sales.join(s.dim_date, "date_key").select(
        "order_id", "line_number", "full_date", "day_name"
    )


@query(
    "dim_date_iso",
    """
SELECT cast(strftime(d, '%Y%m%d') AS int) AS date_key, isodow(d) AS day_of_week,
       strftime(d, '%a') AS day_name
FROM (SELECT cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))
             AS date) AS d FROM orders)""",
)
def dim_date_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = calendar(fx.orders(spark, sf_dir), "order_ts", iso=True)
    return days.select("date_key", "day_of_week", "day_name")
