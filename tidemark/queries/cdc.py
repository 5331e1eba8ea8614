"""Incremental loading over ``orders`` and ``events``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.bookmarks import bookmark_of, seed_bookmarks, upsert_bookmark
from tidemark.operators.digests import unstamped_changes
from tidemark.operators.incremental import (
    batch_summary,
    contract_violations,
    high_watermark,
    incremental_slice,
    with_ingest_metadata,
)
from tidemark.operators.latest import latest_per_key, live_rows
from tidemark.operators.union import stack
from tidemark.plans.dimension_refresh import StoredDimension, Type1, current_rows
from tidemark.plans.landed_state import current_state
from tidemark.plans.incremental_job import Landing, landed_schema, read_landed, run_incremental
from tidemark.queries.fixture import AS_OF, table
from tidemark.queries.registry import query
from tidemark.session import scratch_path
from tidemark.sinks.files import write_files
from tidemark.sinks.releases import publish, read_current
from tidemark.sources.files import read_files
from tidemark.streaming.landing_stream import keep_refreshed, landed_stream, run_available

LO, HI = datetime(1998, 1, 1), datetime(2000, 1, 1)
STAMP = "o_orderdate"
AS_OF_SQL = "TIMESTAMP '2024-06-01 12:00:00'"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


@query("cdc_full_load", "SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2024-06-01 12:00:00'")
def cdc_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_slice(_orders(spark, sf_dir), STAMP, lo=None, hi=AS_OF)


@query(
    "cdc_incremental",
    """SELECT * FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01'""",
)
def cdc_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_slice(_orders(spark, sf_dir), STAMP, LO, HI)


@query(
    "cdc_high_watermark",
    """SELECT max(o_orderdate) AS high_watermark FROM orders
WHERE o_orderdate > TIMESTAMP '1998-01-01' AND o_orderdate <= TIMESTAMP '2000-01-01'""",
)
def cdc_high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_watermark(cdc_incremental(spark, sf_dir), STAMP)


@query(
    "cdc_ingest_metadata",
    f"""SELECT *, {AS_OF_SQL} AS ingested_at, DATE '2024-06-01' AS ingest_date FROM orders""",
)
def cdc_ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ingest_metadata(_orders(spark, sf_dir), AS_OF)


@query(
    "cdc_incremental_by_key",
    """SELECT * FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 3 FROM orders)
AND o_orderkey <= (SELECT 2 * (max(o_orderkey) // 3) FROM orders)""",
)
def cdc_incremental_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number as change column; the bounds cut the keys in three."""
    orders = _orders(spark, sf_dir)
    third = high_watermark(orders, "o_orderkey").first()[0] // 3
    return incremental_slice(orders, "o_orderkey", third, 2 * third)


@query(
    "cdc_incremental_by_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS changed_on FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1998-01-01' AND CAST(o_orderdate AS DATE) <= DATE '2000-01-01'""",
)
def cdc_incremental_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _orders(spark, sf_dir).select("o_orderkey", F.to_date(STAMP).alias("changed_on"))
    return incremental_slice(days, "changed_on", LO.date(), HI.date())


@query(
    "cdc_overlap_replay",
    """SELECT o_orderkey, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders
WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def cdc_overlap_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed versions: rows of the bookmark's own second change between two overlapping runs."""
    landing = Landing(scratch_path(spark, "cdc_overlap_replay"))
    orders = _orders(spark, sf_dir)
    second = timedelta(seconds=1)
    first = run_incremental(spark, "orders", orders, STAMP, landing, AS_OF)
    newest = F.col(STAMP) == F.lit(str(first.bookmark_after)).cast("timestamp_ntz")
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + newest.cast("int"))
    for _ in range(2):
        run_incremental(spark, "orders", changed, STAMP, landing, AS_OF, overlap=second)
    return read_landed(spark, "orders", landing, orders.schema).select("o_orderkey", "o_totalprice")


def _bookmarks(spark: SparkSession, sf_dir: str, names: dict[str, str]) -> DataFrame:
    """Bookmarks of the named sources after everything up to ``HI`` was loaded."""

    def reached(name: str, stamp: str) -> DataFrame:
        loaded = incremental_slice(table(spark, sf_dir, name), stamp, hi=HI)
        return loaded.agg(F.max(stamp).alias("last_value")).select(
            F.lit(name).alias("table_name"),
            "last_value",
            F.lit(str(AS_OF)).cast("timestamp_ntz").alias("updated_at"),
        )

    return stack(*[reached(name, stamp) for name, stamp in names.items()])


SOURCES = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
ORDERS_MARK_SQL = f"""SELECT 'orders' AS table_name, max(o_orderdate) AS last_value,
    {AS_OF_SQL} AS updated_at FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'"""
LINES_MARK_SQL = f"""SELECT 'lineitem' AS table_name, max(l_shipdate) AS last_value,
    {AS_OF_SQL} AS updated_at FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-01-01'"""


@query(
    "cdc_bookmark_seed",
    f"""{ORDERS_MARK_SQL} UNION ALL {LINES_MARK_SQL}
UNION ALL SELECT DISTINCT event_type, TIMESTAMP '1970-01-01', {AS_OF_SQL} FROM events""",
)
def cdc_bookmark_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known sources keep their bookmark; each event type starts as a source of its own."""
    known = _bookmarks(spark, sf_dir, SOURCES)
    kinds = table(spark, sf_dir, "events").select(F.col("event_type").alias("table_name"))
    return seed_bookmarks(known, kinds.unionByName(known.select("table_name")), AS_OF)


@query("cdc_bookmark_read", f"{ORDERS_MARK_SQL}")
def cdc_bookmark_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookmark_of(_bookmarks(spark, sf_dir, SOURCES), "orders")


@query("cdc_bookmark_read_by_key", "SELECT 'orders' AS table_name, cast(max(o_orderkey) AS varchar) AS mark FROM orders")
def cdc_bookmark_read_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bookmark of a source that is loaded by a number."""
    landing = Landing(scratch_path(spark, "cdc_bookmark_read_by_key"))
    run_incremental(spark, "orders", _orders(spark, sf_dir), "o_orderkey", landing, AS_OF)
    return landing.bookmarks(spark).select("table_name", "mark")


COPY_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'P'
                THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P'
                THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate, o_orderpriority
    FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
    UNION ALL
    SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'"""


@query(
    "cdc_unstamped_changes",
    f"""WITH held AS ({COPY_SQL})
SELECT coalesce(s.o_orderkey, c.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN 'gone'
            WHEN c.o_orderkey IS NULL OR s.o_orderdate > c.o_orderdate THEN 'unloaded'
            ELSE 'unstamped' END AS finding
FROM orders s FULL JOIN held c ON s.o_orderkey = c.o_orderkey
WHERE s.o_orderkey IS NULL OR c.o_orderkey IS NULL OR s.o_totalprice <> c.o_totalprice
   OR s.o_orderdate <> c.o_orderdate""",
)
def cdc_unstamped_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compare ``orders`` with a copy that missed changes, rows and deletions of pending orders."""
    orders, pending = _orders(spark, sf_dir), F.col("o_orderstatus") == "P"
    kind = lambda *p: F.col("o_orderpriority").isin(*p) & pending
    price, stamp = F.col("o_totalprice"), F.col(STAMP)
    copy = orders.filter(~kind("5-LOW")).withColumns(
        {
            "o_totalprice": F.when(kind("1-URGENT", "2-HIGH"), price + 1).otherwise(price),
            STAMP: F.when(kind("2-HIGH"), stamp - F.expr("INTERVAL 1 DAY")).otherwise(stamp),
        }
    )
    deleted = orders.filter(kind("3-MEDIUM")).withColumn("o_orderkey", -F.col("o_orderkey"))
    return unstamped_changes(orders, stack(copy, deleted), ["o_orderkey"], STAMP)


@query(
    "cdc_bookmark_upsert",
    f"""{LINES_MARK_SQL} UNION ALL
SELECT 'orders', max(o_orderdate), TIMESTAMP '2024-06-01 12:00:00' FROM orders""",
)
def cdc_bookmark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Move one bookmark to the end of its source; the other one survives."""
    end = high_watermark(_orders(spark, sf_dir), STAMP).first()[0]
    return upsert_bookmark(_bookmarks(spark, sf_dir, SOURCES), "orders", end, AS_OF)


@query(
    "cdc_empty_batch",
    """SELECT count(*) FILTER (o_orderdate > (SELECT max(o_orderdate) FROM orders)) AS row_count,
    max(o_orderdate) AS last_value FROM orders""",
)
def cdc_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing changed since the bookmark: no rows, and the bookmark stays."""
    orders = _orders(spark, sf_dir)
    lo = high_watermark(orders, STAMP).first()[0]
    return batch_summary(incremental_slice(orders, STAMP, lo, AS_OF), STAMP, lo)


@query(
    "cdc_contract",
    """SELECT count(*) FILTER (o_orderdate IS NULL) AS without_change_time,
    count(*) FILTER (o_orderdate > TIMESTAMP '2000-01-01') AS beyond_upper_bound FROM orders""",
)
def cdc_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_violations(_orders(spark, sf_dir), STAMP, HI)


@query(
    "cdc_soft_delete",
    """SELECT * FROM (
    SELECT * FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
WHERE event_type <> 'error'""",
)
def cdc_soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``error`` plays the delete flag; a later event of another type restores the user."""
    events = table(spark, sf_dir, "events")
    return live_rows(events, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")


LATEST_EVENT_SQL = """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


@query("cdc_current_state", LATEST_EVENT_SQL)
def cdc_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


SLICES = [datetime(1997, 1, 1), datetime(1999, 1, 1), None]
BY_STATUS_SQL = """SELECT o_orderstatus, count(*) AS row_count,
    cast(sum(cast(o_totalprice AS decimal(10,2))) AS double) AS total_price
FROM orders GROUP BY 1"""


def _by_status(orders: DataFrame) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(10,2)")).cast("double")
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"), total.alias("total_price")
    )


def _land_slices(spark: SparkSession, sf_dir: str, landing: Landing) -> DataFrame:
    """Load ``orders`` in three runs, each up to a later bound."""
    orders = _orders(spark, sf_dir)
    for hi in SLICES:
        run_incremental(spark, "orders", orders, STAMP, landing, AS_OF, hi)
    return orders


@query("cdc_end_to_end", BY_STATUS_SQL)
def cdc_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = Landing(scratch_path(spark, "cdc_end_to_end"))
    orders = _land_slices(spark, sf_dir, landing)
    return _by_status(read_landed(spark, "orders", landing, orders.schema))


@query(
    "cdc_stream_latest",
    """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def cdc_stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land in slices, then let a stream take up the landed files and keep the latest rows."""
    root = scratch_path(spark, "cdc_stream_latest")
    landing = Landing(root)
    orders = _land_slices(spark, sf_dir, landing)
    schema = landed_schema(orders.schema).add("batch_id", "string")
    stream = landed_stream(spark, landing.batches("orders"), schema).select(*orders.columns)
    latest = StoredDimension(f"{root}/latest", Type1(["o_custkey"], [STAMP, "o_orderkey"]), buckets=8)
    run_available(stream, keep_refreshed(latest, AS_OF), f"{root}/stream-checkpoint")
    return current_rows(spark, latest)


@query(
    "cdc_compacted_state",
    """SELECT * FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def cdc_compacted_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order per customer, kept up to date after each of three loads."""
    landing, orders = Landing(scratch_path(spark, "cdc_compacted_state")), _orders(spark, sf_dir)
    for hi in SLICES:
        run_incremental(spark, "orders", orders, STAMP, landing, AS_OF, hi)
        state = current_state(spark, "orders", landing, orders.schema, ["o_custkey"], [STAMP, "o_orderkey"], AS_OF, 8)
    return state


def _through_csv(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    write_files(df, path, "csv")
    return read_files(df.sparkSession, path, "csv", df.schema)


@query("sink_csv_roundtrip", "SELECT * FROM orders")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(_orders(spark, sf_dir), "sink_csv_roundtrip")


@query("sink_csv_roundtrip_events", "SELECT * FROM events")
def sink_csv_roundtrip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(table(spark, sf_dir, "events"), "sink_csv_roundtrip_events")


@query(
    "sink_parquet_partitioned",
    """SELECT DATE '2024-06-01' AS ingest_date, o_orderpriority, count(*) AS row_count
FROM orders GROUP BY 2""",
)
def sink_parquet_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "sink_parquet_partitioned")
    stamped = with_ingest_metadata(_orders(spark, sf_dir), AS_OF)
    write_files(stamped, path, partition_by=["ingest_date"])
    landed = read_files(spark, path, schema=stamped.schema)
    return landed.groupBy("ingest_date", "o_orderpriority").agg(F.count("*").alias("row_count"))


@query(
    "full_refresh",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderdate <= TIMESTAMP '2000-01-01'""",
)
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all rows, then replace them by another selection; readers see the second."""
    root = scratch_path(spark, "full_refresh")
    rows = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", STAMP)
    publish({"orders": rows}, root, "r1", LO)
    publish({"orders": incremental_slice(rows, STAMP, hi=HI)}, root, "r2", HI)
    return read_current(spark, root, "orders")[0].drop(STAMP)
