"""Small tables with known answers. All rows are fixed values: the answers depend on them."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

T1 = datetime(2026, 1, 3, 9, 1, 31)
T2 = datetime(2026, 1, 3, 10, 15)

BATCH_SCHEMA = (
    "customer_id string, first_name string, last_name string, email string, city string,"
    " phone string, is_active boolean, last_modified_ts timestamp_ntz"
)
RUN1 = [
    ("C001", "Amit", "Shah", "amit@gmail.com", "Pune", "1111", True, T1),
    ("C002", "Neha", "Patil", "neha@gmail.com", "Mumbai", "2222", False, T1),
    ("C003", "Ravi", "Kale", "ravi@gmail.com", "Nagpur", "3333", True, T1),
]
RUN2 = [
    ("C001", "Amit", "Shah", "amit@gmail.com", "Pune - Hinjewadi", "9999", True, T2),
    ("C002", "Neha", "Patil", "neha@gmail.com", "Mumbai", "2222", True, T2),
    ("C004", "Sita", "More", "sita@gmail.com", "Nashik", "4444", True, T2),
    ("C005", "Vikas", "Jadhav", "vikas@gmail.com", "Pune", "5555", True, T2),
]
TRACKED = ["city", "phone", "is_active"]

STAGING_SCHEMA = (
    "customer_id int, full_name string, email string, city string, updated_at timestamp_ntz"
)


def staging(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), STAGING_SCHEMA)


def batch(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, BATCH_SCHEMA)


def day(d: int, h: int = 0, m: int = 0, month: int = 2) -> datetime:
    return datetime(2024, month, d, h, m)


def model(spark: SparkSession) -> dict[str, DataFrame]:
    """Five normalized tables: six orders, one of them cancelled, ten lines."""
    customers = [
        (1, "Rahul", "Sharma", "rahul@example.com", "Mumbai", "MH", day(1, 10, month=1)),
        (2, "Anjali", "Patil", "anjali@example.com", "Pune", "MH", day(3, 11, month=1)),
        (3, "Amit", "Verma", "amit@example.com", "Bengaluru", "KA", day(5, 9, 30, month=1)),
        (4, "Neha", "Singh", "neha@example.com", "Delhi", "DL", day(6, 15, 10, month=1)),
        (5, "Kiran", "Joshi", "kiran@example.com", "Mumbai", "MH", day(7, 8, 45, month=1)),
    ]
    categories = [(10, "Electronics"), (20, "Accessories"), (30, "Home")]
    made = datetime(2023, 12, 1, 10)
    products = [
        (101, "Laptop Pro 14", 10, Decimal("70000.00"), 1, made),
        (102, "Wireless Mouse", 20, Decimal("800.00"), 1, made),
        (103, "Mechanical Keyboard", 20, Decimal("3500.00"), 1, made),
        (104, "Coffee Maker", 30, Decimal("4500.00"), 1, made),
        (105, "Noise Cancel Headphones", 10, Decimal("9000.00"), None, made),
    ]
    orders = [
        (1001, 1, day(1, 9, 10), "PLACED", Decimal("72400.00")),
        (1002, 2, day(1, 12, 40), "PLACED", Decimal("4300.00")),
        (1003, 1, day(2, 18, 5), "CANCELLED", Decimal("800.00")),
        (1004, 3, day(3, 10, 20), "PLACED", Decimal("12500.00")),
        (1005, 4, day(3, 21, 15), "PLACED", Decimal("4500.00")),
        (1006, 5, day(4, 11, 30), "PLACED", Decimal("8600.00")),
    ]
    lines = [
        (1001, 1, 101, 1, "70000.00", "0.00"),
        (1001, 2, 102, 3, "800.00", "0.00"),
        (1002, 1, 103, 1, "3500.00", "200.00"),
        (1002, 2, 102, 1, "800.00", "0.00"),
        (1003, 1, 102, 1, "800.00", "0.00"),
        (1004, 1, 105, 1, "9000.00", "500.00"),
        (1004, 2, 103, 1, "3500.00", "0.00"),
        (1005, 1, 104, 1, "4500.00", "0.00"),
        (1006, 1, 102, 2, "800.00", "0.00"),
        (1006, 2, 103, 2, "3500.00", "0.00"),
    ]
    items = [(o, n, p, q, Decimal(u), Decimal(d)) for o, n, p, q, u, d in lines]
    return {
        "customers": spark.createDataFrame(
            customers,
            "customer_id int, first_name string, last_name string, email string, city string,"
            " state string, created_at timestamp_ntz",
        ),
        "categories": spark.createDataFrame(categories, "category_id int, category_name string"),
        "products": spark.createDataFrame(
            products,
            "product_id int, product_name string, category_id int, list_price decimal(10,2),"
            " is_active int, created_at timestamp_ntz",
        ),
        "orders": spark.createDataFrame(
            orders,
            "order_id int, customer_id int, order_ts timestamp_ntz, order_status string,"
            " order_total decimal(10,2)",
        ),
        "items": spark.createDataFrame(
            items,
            "order_id int, line_number int, product_id int, quantity int,"
            " unit_price decimal(10,2), discount_amount decimal(10,2)",
        ),
    }
