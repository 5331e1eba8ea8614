"""Data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import quality
from tidemark.operators.union import stack
from tidemark.queries.fixture import key_sql, table
from tidemark.queries.registry import query
from tidemark.queries.revenue import star


@query(
    "dq_unique",
    """
SELECT 'o_orderkey' AS check_name, count(*) AS repeated_keys,
       cast(coalesce(sum(n - 1), 0) AS bigint) AS surplus_rows
FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL
SELECT 'c_custkey', count(*), cast(coalesce(sum(n - 1), 0) AS bigint)
FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL
SELECT 'l_orderkey, l_linenumber', count(*), cast(coalesce(sum(n - 1), 0) AS bigint)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.uniqueness(
        {
            "o_orderkey": (table(spark, sf_dir, "orders"), ["o_orderkey"]),
            "c_custkey": (table(spark, sf_dir, "customer"), ["c_custkey"]),
            "l_orderkey, l_linenumber": (
                table(spark, sf_dir, "lineitem"),
                ["l_orderkey", "l_linenumber"],
            ),
        }
    )


def _orphans_sql(name: str, child: str, fk: str, parent: str, pk: str) -> str:
    return f"""
SELECT '{name}' AS check_name, count(DISTINCT {fk}) AS orphan_keys, count(*) AS orphan_rows
FROM {child} WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent})"""


ORPHAN_CHECKS = [
    ("lineitem without order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem without part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("order without customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("order without lines", "orders", "o_orderkey", "lineitem", "l_orderkey"),
]


@query("dq_orphans", " UNION ALL ".join(_orphans_sql(*check) for check in ORPHAN_CHECKS))
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both directions between orders and lines come from one join."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    return stack(
        quality.references_between(lines, "l_orderkey", orders, "o_orderkey", "lineitem without order", "order without lines"),
        quality.references_between(lines, "l_partkey", part, "p_partkey", "lineitem without part", None),
        quality.references_between(orders, "o_custkey", customer, "c_custkey", "order without customer", None),
    )


def _unique_key_sql(name: str, source: str, natural: str) -> str:
    return f"""
SELECT '{name}' AS check_name, count(*) FILTER (n > 1) AS repeated_keys,
       cast(coalesce(sum(n - 1), 0) AS bigint) AS surplus_rows
FROM (SELECT count(*) AS n FROM {source} GROUP BY {key_sql(natural)})"""


@query(
    "dq_surrogate_unique",
    _unique_key_sql("dim_customer", "customer", "c_custkey")
    + " UNION ALL "
    + _unique_key_sql("dim_product", "part", "p_partkey"),
)
def dq_surrogate_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No two dimension rows share a hashed key."""
    built = star(spark, sf_dir)
    return quality.uniqueness(
        {"dim_customer": (built.dim_customer, ["customer_key"]), "dim_product": (built.dim_product, ["product_key"])}
    )



NULL_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"]


@query(
    "dq_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM orders"
        for c in NULL_COLUMNS
    ),
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(table(spark, sf_dir, "orders"), NULL_COLUMNS)


COUNTED = ["customer", "part", "orders", "lineitem", "events"]


@query(
    "agg_row_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED
    ),
)
def agg_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts({name: table(spark, sf_dir, name) for name in COUNTED})
