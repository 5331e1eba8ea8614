"""What the star and stored tables shuffle and write."""

from __future__ import annotations

import os
from datetime import datetime

from tidemark.operators.carry import laid_out
from tidemark.operators.facts import fact_sales
from tidemark.sinks.files import write_files
from tidemark.sinks.overwrite import replace_partitions


def files_below(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_lines_are_shuffled_with_product_ids_instead_of_hashes(spark):
    items = spark.createDataFrame([(1, 1, 7, 2, 5.0, 1.0)], "order_id long, line_number int, product_id long, quantity int, unit_price double, discount_amount double")
    orders = spark.createDataFrame([(1, 3, datetime(2024, 1, 2), "F")], "order_id long, customer_id long, order_ts timestamp_ntz, order_status string")
    fact = fact_sales(items, orders)
    plan = fact._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan[: plan.index("Join")], plan[plan.index("Join") :]
    assert "sha2" in above and "product_id" in below and below.count("sha2") == 1  # the customer's, once per order
    assert fact.count() == 1


def test_stored_tables_are_written_with_zstd(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    write_files(rows, f"{tmp_path}/plain")
    laid_out(rows, ["k"], ["v"], f"{tmp_path}/placed", 2)
    replace_partitions(rows, f"{tmp_path}/table", "r1", datetime(2024, 1, 1), ["k"])
    for folder in ("plain", "placed", "table/data"):
        found = files_below(f"{tmp_path}/{folder}")
        assert found and all(".zstd." in f for f in found)
