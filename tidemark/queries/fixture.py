"""The given tables in the shape of the library's models.

Normalized model: customers carry their nation as city and region as state, part types
are the categories, and order status ``F`` stands for a placed order. A line's unit price
is its extended price; its discount is price times rate, rounded to cents. Binary floats
become decimals here, before any arithmetic.

Change model: ``orders`` is read as a log of changes to customers. The latest order of a
customer gives the customer's status and priority, where the lowest priority counts as
not set (NULL). A bookmark in the middle of the log splits it into two batches that
together hold every order.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions import surrogate_key
from tidemark.operators.incremental import incremental_slice
from tidemark.operators.latest import latest_per_key
from tidemark.operators.scd2 import Scd2

PLACED = "F"
BOOKMARK = datetime(1998, 4, 15)
AS_OF = datetime(2024, 6, 1, 12, 0, 0)
PRODUCT_COLUMNS = ["product_name", "category_id", "category_name", "list_price", "is_active"]
CUSTOMER_COLUMNS = ["first_name", "last_name", "city", "state"]

BATCH_KEYS = ["customer_id"]
BATCH_ORDER = ["last_modified_ts", "order_id"]
TRACKED = ["order_status", "order_priority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(col: str) -> Column:
    return F.col(col).cast("decimal(10,2)")


def as_float(*cols: str) -> dict[str, Column]:
    """Exact decimals as doubles, the type in which results are compared."""
    return {c: F.col(c).cast("double") for c in cols}


@dataclass(frozen=True)
class Normalized:
    customers: DataFrame
    categories: DataFrame
    products: DataFrame
    orders: DataFrame
    items: DataFrame


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    name = F.split("c_name", "#")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            name[0].alias("first_name"),
            name[1].alias("last_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.col("p_type").alias("category_name")).distinct()
    return names.select(surrogate_key(F.col("category_name")).alias("category_id"), "category_name")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        surrogate_key(F.col("p_type")).alias("category_id"),
        cents("p_retailprice").alias("list_price"),
        F.lit(None).cast("int").alias("is_active"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderstatus").alias("order_status"),
        cents("o_totalprice").alias("order_total"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = cents("l_extendedprice")
    discount = price * F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("unit_price"),
        discount.cast("decimal(10,2)").alias("discount_amount"),
    )


def normalized(spark: SparkSession, sf_dir: str) -> Normalized:
    return Normalized(
        *(read(spark, sf_dir) for read in (customers, categories, products, orders, items))
    )


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with their category's name."""
    return products(spark, sf_dir).join(categories(spark, sf_dir), "category_id")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("order_priority"),
        F.col("o_orderdate").alias("last_modified_ts"),
    )


def latest_changes(df: DataFrame) -> DataFrame:
    return latest_per_key(df, BATCH_KEYS, BATCH_ORDER)


def run1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest change per customer up to the bookmark."""
    return latest_changes(incremental_slice(changes(spark, sf_dir), "last_modified_ts", hi=BOOKMARK))


def slice2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes after the bookmark, several per customer."""
    return incremental_slice(changes(spark, sf_dir), "last_modified_ts", lo=BOOKMARK)


def run2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_changes(slice2(spark, sf_dir))


def late2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``run2`` with the pending customers' changes dated ten years back: they arrive late."""
    stamp = F.col("last_modified_ts")
    shifted = F.when(F.col("order_status") == "P", stamp - F.expr("INTERVAL 3650 DAY"))
    return run2(spark, sf_dir).withColumn("last_modified_ts", shifted.otherwise(stamp))


SCD2 = Scd2(BATCH_KEYS, TRACKED, "last_modified_ts", order_cols=BATCH_ORDER)

# The same models as SQL, for the statements the queries are compared with.
NET_SQL = (
    "(cast(l_quantity as int) * cast(l_extendedprice as decimal(10,2))"
    " - cast(cast(l_extendedprice as decimal(10,2)) * cast(l_discount as decimal(4,2))"
    " as decimal(10,2)))"
)
CHANGES_SQL = """
    SELECT o_custkey AS customer_id, o_orderkey AS order_id, o_orderstatus AS order_status,
           nullif(o_orderpriority, '5-LOW') AS order_priority, o_orderdate AS last_modified_ts
    FROM orders"""
RUNS_SQL = f"""
WITH changes AS ({CHANGES_SQL}),
run1 AS (
    SELECT * FROM changes WHERE last_modified_ts <= TIMESTAMP '1998-04-15'
    QUALIFY row_number() OVER (
        PARTITION BY customer_id ORDER BY last_modified_ts DESC, order_id DESC) = 1),
run2 AS (
    SELECT * FROM changes WHERE last_modified_ts > TIMESTAMP '1998-04-15'
    QUALIFY row_number() OVER (
        PARTITION BY customer_id ORDER BY last_modified_ts DESC, order_id DESC) = 1),
late2 AS (
    SELECT customer_id, order_id, order_status, order_priority,
           CASE WHEN order_status = 'P' THEN last_modified_ts - INTERVAL 3650 DAY
                ELSE last_modified_ts END AS last_modified_ts
    FROM run2)"""
MOVED_SQL = (
    "(a.order_status IS DISTINCT FROM b.order_status"
    " OR a.order_priority IS DISTINCT FROM b.order_priority)"
)


def key_sql(expression: str) -> str:
    return f"cast('0x' || substr(sha256(cast({expression} AS varchar)), 1, 15) AS bigint)"
