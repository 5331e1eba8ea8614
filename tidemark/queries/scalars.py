"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import day_name, day_of_week, date_key, line_gross, line_net, surrogate_key
from tidemark.queries import fixture as fx
from tidemark.queries.fixture import NET_SQL, as_float, key_sql, table
from tidemark.queries.registry import query


@query(
    "fn_surrogate_key",
    f"SELECT p_partkey, p_brand, {key_sql('p_partkey')} AS part_key, {key_sql('p_brand')} AS brand_key FROM part",
)
def fn_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_brand",
        surrogate_key(F.col("p_partkey")).alias("part_key"),
        surrogate_key(F.col("p_brand")).alias("brand_key"),
    )


@query(
    "fn_casts",
    """SELECT p_partkey, cast(p_partkey AS varchar) AS key_text, cast(p_partkey AS int) AS key_int,
       cast(p_size AS bigint) AS size_long,
       cast(cast(p_retailprice AS decimal(10,2)) AS varchar) AS price_text,
       try_cast(substr(p_brand, 7) AS int) AS brand_number,
       try_cast(p_brand AS int) IS NULL AS brand_is_text
FROM part""",
)
def fn_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain casts fail on bad input; ``try_cast`` yields NULL instead."""
    brand = F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("key_text"),
        F.col("p_partkey").cast("int").alias("key_int"),
        F.col("p_size").cast("long").alias("size_long"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price_text"),
        F.substring(brand, 7, 10).try_cast("int").alias("brand_number"),
        brand.try_cast("int").isNull().alias("brand_is_text"),
    )


@query(
    "fn_date_parts",
    """SELECT o_orderkey, cast(o_orderdate AS date) AS full_date,
       cast(strftime(o_orderdate, '%Y%m%d') AS int) AS date_key, year(o_orderdate) AS year_num,
       month(o_orderdate) AS month_num, day(o_orderdate) AS day_num,
       dayofweek(o_orderdate) + 1 AS day_of_week, isodow(o_orderdate) AS iso_day_of_week,
       strftime(o_orderdate, '%a') AS day_name
FROM orders""",
)
def fn_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("full_date"),
        date_key(day).alias("date_key"),
        F.year(day).alias("year_num"),
        F.month(day).alias("month_num"),
        F.dayofmonth(day).alias("day_num"),
        day_of_week(day).alias("day_of_week"),
        day_of_week(day, iso=True).alias("iso_day_of_week"),
        day_name(day).alias("day_name"),
    )


@query(
    "fn_to_timestamp",
    """SELECT o_orderkey, strptime(strftime(o_orderdate, '%d/%m/%Y') || ' 09:01:31',
                            '%d/%m/%Y %H:%M:%S') AS parsed_ts
FROM orders""",
)
def fn_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.date_format(F.to_date("o_orderdate"), "dd/MM/yyyy"), F.lit(" 09:01:31"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_timestamp_ntz(text, F.lit("dd/MM/yyyy HH:mm:ss")).alias("parsed_ts"),
    )


@query(
    "fn_coalesce",
    f"""{fx.RUNS_SQL}
SELECT customer_id, order_id, coalesce(order_priority, order_status) AS rank_text,
       coalesce(order_priority, 'not set') AS priority_text
FROM changes""",
)
def fn_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.changes(spark, sf_dir).select(
        "customer_id",
        "order_id",
        F.coalesce("order_priority", "order_status").alias("rank_text"),
        F.coalesce("order_priority", F.lit("not set")).alias("priority_text"),
    )


@query(
    "fn_case",
    """SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'F' THEN 'placed' WHEN o_orderstatus = 'P' THEN 'pending'
            ELSE 'open' END AS status_text,
       CASE WHEN o_totalprice > 250000 THEN o_orderpriority END AS large_priority
FROM orders""",
)
def fn_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", "placed").when(status == "P", "pending").otherwise("open").alias(
            "status_text"
        ),
        F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("large_priority"),
    )


@query(
    "fn_decimal_arith",
    f"""SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       cast(cast(l_quantity AS int) * cast(l_extendedprice AS decimal(10,2)) AS double)
           AS gross_amount,
       cast({NET_SQL} AS double) AS net_amount, l_linenumber + 1 AS next_line
FROM lineitem""",
)
def fn_decimal_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity, price = F.col("quantity"), F.col("unit_price")
    amounts = fx.items(spark, sf_dir).select(
        "order_id",
        "line_number",
        line_gross(quantity, price).alias("gross_amount"),
        line_net(quantity, price, F.col("discount_amount")).alias("net_amount"),
        (F.col("line_number") + 1).alias("next_line"),
    )
    return amounts.withColumns(as_float("gross_amount", "net_amount"))
