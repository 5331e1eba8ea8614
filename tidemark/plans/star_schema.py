"""Declared schemas of the star tables.

Keys are bigint throughout, so that they hold beyond two billion customers or orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemark.operators.quality import null_counts

# The tables' columns and types, in order. Every column is required.
STAR_COLUMNS = {
    "dim_customer": (
        "customer_key bigint, customer_id bigint, first_name string, last_name string,"
        " email string, city string, state string, created_at timestamp_ntz"
    ),
    "dim_product": (
        "product_key bigint, product_id bigint, product_name string, category_id bigint,"
        " category_name string, list_price decimal(10,2), is_active int,"
        " created_at timestamp_ntz"
    ),
    "dim_date": (
        "date_key int, full_date date, year_num int, month_num int, day_num int,"
        " day_of_week int, day_name string"
    ),
    "fact_sales": (
        "order_id bigint, line_number int, customer_key bigint, product_key bigint,"
        " date_key int, order_status string, quantity int, unit_price decimal(10,2),"
        " discount_amount decimal(10,2), gross_amount decimal(10,2), net_amount decimal(10,2)"
    ),
}

NATURAL_KEYS = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "dim_date": ["full_date"],
    "fact_sales": ["order_id", "line_number"],
}


def star_schema(table: str) -> StructType:
    return StructType.fromDDL(STAR_COLUMNS[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in their order and types; a missing column is an error."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in star_schema(table).fields]
    )


def missing_values(df: DataFrame, table: str) -> DataFrame:
    """NULLs per required column."""
    return null_counts(df, star_schema(table).names)
