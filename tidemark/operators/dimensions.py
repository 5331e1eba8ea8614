"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import date_key, day_name, day_of_week, surrogate_key
from tidemark.operators.update import fill_defaults

# The attributes of the model, in order.
CUSTOMER_ATTRIBUTES = ["first_name", "last_name", "email", "city", "state", "created_at"]
PRODUCT_ATTRIBUTES = [
    "product_name",
    "category_id",
    "category_name",
    "list_price",
    "is_active",
    "created_at",
]


def dimension(
    df: DataFrame, natural_key: str, key_name: str, attributes: list[str]
) -> DataFrame:
    """Surrogate key, natural key and attributes; a row-wise projection."""
    return df.select(surrogate_key(F.col(natural_key)).alias(key_name), natural_key, *attributes)


def dim_customer(customers: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    return dimension(
        customers, "customer_id", "customer_key", attributes or CUSTOMER_ATTRIBUTES
    )


def dim_product(
    products: DataFrame, categories: DataFrame, attributes: list[str] | None = None
) -> DataFrame:
    """Product dimension with the category name copied in; unknown categories stay NULL."""
    denormalised = products.join(categories, "category_id", "left").withColumns(
        {
            "list_price": F.col("list_price").cast("decimal(10,2)"),
            "is_active": F.col("is_active").cast("int"),
        }
    )
    return dimension(
        fill_defaults(denormalised, {"is_active": 1}), "product_id", "product_key", attributes or PRODUCT_ATTRIBUTES
    )


def dim_date(df: DataFrame, ts_col: str, iso: bool = False) -> DataFrame:
    """One row per day from the first to the last day in ``ts_col``; none for no rows.

    One plan without a driver round trip: the bounds are aggregated and expanded in place.
    """
    day = F.col("full_date")
    bounds = df.agg(
        F.min(ts_col).cast("date").alias("first_day"),
        F.max(ts_col).cast("date").alias("last_day"),
    ).filter(F.col("first_day").isNotNull())
    days = F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("full_date")).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year_num"),
        F.month(day).alias("month_num"),
        F.dayofmonth(day).alias("day_num"),
        day_of_week(day, iso).alias("day_of_week"),
        day_name(day).alias("day_name"),
    )
