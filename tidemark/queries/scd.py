"""Slowly changing dimensions over the two batches of customer changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import any_differs, differs
from tidemark.operators.as_of import as_of_join
from tidemark.operators.incremental import incremental_slice
from tidemark.operators.scd1 import scd1_merge
from tidemark.operators.scd2 import OPENS
from tidemark.operators.scd3 import scd3_initial, scd3_merge
from tidemark.operators.union import stack
from tidemark.operators.update import update_where
from tidemark.plans.dimension_refresh import StoredDimension, Type1, Type3, current_rows, read_dimension, refresh_dimension
from tidemark.queries import fixture as fx
from tidemark.queries.fixture import AS_OF, BATCH_KEYS, BATCH_ORDER, CHANGES_SQL, MOVED_SQL, RUNS_SQL, SCD2
from tidemark.queries.registry import query
from tidemark.session import scratch_path

BASE = "customer_id, order_id, order_status, order_priority, last_modified_ts"


def _prefixed(alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in BASE.split(","))


def _shown(df: DataFrame) -> DataFrame:
    """Interval ends as text: the open end in year 9999 does not fit a nanosecond clock."""
    return df.withColumn("effective_to", F.col("effective_to").cast("string"))


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SCD2.initial(fx.run1(spark, sf_dir))


def _changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    dim = _dim(spark, sf_dir)
    return dim, SCD2.changes(dim, fx.slice2(spark, sf_dir))


@query(
    "scd1_latest",
    f"""{RUNS_SQL}
SELECT {BASE} FROM (SELECT * FROM run1 UNION ALL SELECT * FROM late2)
QUALIFY row_number() OVER (
    PARTITION BY customer_id ORDER BY last_modified_ts DESC, order_id DESC) = 1""",
)
def scd1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1_merge(fx.run1(spark, sf_dir), fx.late2(spark, sf_dir), BATCH_KEYS, BATCH_ORDER)


@query(
    "scd1_upsert",
    f"""{RUNS_SQL}
SELECT {BASE} FROM late2
UNION ALL SELECT {BASE} FROM run1 WHERE customer_id NOT IN (SELECT customer_id FROM late2)""",
)
def scd1_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1_merge(
        fx.run1(spark, sf_dir),
        fx.late2(spark, sf_dir),
        BATCH_KEYS,
        BATCH_ORDER,
        incoming_wins=True,
    )


@query(
    "scd_change_detect",
    f"""{RUNS_SQL}
SELECT customer_id, a.order_status IS DISTINCT FROM b.order_status AS status_changed,
       a.order_priority IS DISTINCT FROM b.order_priority AS priority_changed
FROM run1 a JOIN run2 b USING (customer_id)""",
)
def scd_change_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, changes = _changes(spark, sf_dir)
    was, now = F.col("was"), F.col("now")
    return changes.filter(was.isNotNull() & now.isNotNull()).select(
        "customer_id",
        differs(was["order_status"], now["order_status"]).alias("status_changed"),
        differs(was["order_priority"], now["order_priority"]).alias("priority_changed"),
    )


LATEST_SQL = f"""WITH newest AS (
    SELECT * FROM ({CHANGES_SQL})
    QUALIFY row_number() OVER (
        PARTITION BY customer_id ORDER BY last_modified_ts DESC, order_id DESC) = 1)"""


def _newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.latest_changes(fx.changes(spark, sf_dir))


@query(
    "scd2_initial",
    f"""{LATEST_SQL}
SELECT {BASE}, last_modified_ts AS effective_from, '9999-12-31 00:00:00' AS effective_to,
       true AS is_current, 1 AS version FROM newest""",
)
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load of the newest change of every customer in the whole log."""
    return _shown(SCD2.initial(_newest(spark, sf_dir)))


@query(
    "scd2_changed_keys",
    f"""{RUNS_SQL}
SELECT customer_id FROM run1 a JOIN run2 b USING (customer_id) WHERE {MOVED_SQL}""",
)
def scd2_changed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, changes = _changes(spark, sf_dir)
    return SCD2.changed_keys(changes)


CLOSED_SQL = f"""
SELECT {_prefixed("a")}, a.last_modified_ts AS effective_from,
       cast(b.last_modified_ts AS varchar) AS effective_to, false AS is_current, 1 AS version
FROM run1 a JOIN run2 b USING (customer_id) WHERE {MOVED_SQL}"""

NEXT_SQL = f"""
SELECT {_prefixed("b")}, b.last_modified_ts AS effective_from,
       '9999-12-31 00:00:00' AS effective_to, true AS is_current, 2 AS version
FROM run1 a JOIN run2 b USING (customer_id) WHERE {MOVED_SQL}"""

FIRST_SQL = f"""
SELECT {_prefixed("b")}, b.last_modified_ts AS effective_from,
       '9999-12-31 00:00:00' AS effective_to, true AS is_current, 1 AS version
FROM run2 b WHERE b.customer_id NOT IN (SELECT customer_id FROM run1)"""

KEPT_SQL = f"""
SELECT {_prefixed("a")}, a.last_modified_ts AS effective_from,
       '9999-12-31 00:00:00' AS effective_to, true AS is_current, 1 AS version
FROM run1 a LEFT JOIN run2 b USING (customer_id)
WHERE b.order_id IS NULL OR NOT {MOVED_SQL}"""


@query("scd2_expire", f"{RUNS_SQL} {CLOSED_SQL}")
def scd2_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(SCD2.expired(*_changes(spark, sf_dir)))


@query("scd2_new_versions", f"{RUNS_SQL} {NEXT_SQL}")
def scd2_new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(SCD2.new_versions(*_changes(spark, sf_dir)))


@query("scd2_new_keys", f"{RUNS_SQL} {FIRST_SQL}")
def scd2_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(SCD2.new_keys(*_changes(spark, sf_dir)))


MERGED_SQL = f"{CLOSED_SQL} UNION ALL {NEXT_SQL} UNION ALL {FIRST_SQL} UNION ALL {KEPT_SQL}"
VIEW_SQL = f"{NEXT_SQL} UNION ALL {FIRST_SQL} UNION ALL {KEPT_SQL}"


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SCD2.merge(_dim(spark, sf_dir), fx.slice2(spark, sf_dir))


@query("scd2_merge", f"{RUNS_SQL} {MERGED_SQL}")
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_merged(spark, sf_dir))


@query("scd2_current_view", f"{RUNS_SQL} {VIEW_SQL}")
def scd2_current_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(SCD2.current_view(_merged(spark, sf_dir)))


VERSIONS_SQL = f"""
steps AS (
    SELECT *, lag(order_id) OVER w AS before_id, lag(order_status) OVER w AS before_status,
           lag(order_priority) OVER w AS before_priority FROM log
    WINDOW w AS (PARTITION BY customer_id ORDER BY last_modified_ts, order_id)),
opened AS (
    SELECT * FROM steps WHERE before_id IS NULL OR order_status IS DISTINCT FROM before_status
        OR order_priority IS DISTINCT FROM before_priority)
SELECT {BASE}, last_modified_ts AS effective_from,
       coalesce(cast(lead(last_modified_ts) OVER w AS varchar), '9999-12-31 00:00:00') AS effective_to,
       lead(last_modified_ts) OVER w IS NULL AS is_current, row_number() OVER w AS version
FROM opened WINDOW w AS (PARTITION BY customer_id ORDER BY last_modified_ts, order_id)"""
ALL_VERSIONS_SQL = f"""
log AS (
    SELECT {BASE} FROM run1
    UNION ALL SELECT {BASE} FROM changes WHERE last_modified_ts > TIMESTAMP '1998-04-15'),
{VERSIONS_SQL}"""


@query("scd2_merge_all_versions", f"{RUNS_SQL}, {ALL_VERSIONS_SQL}")
def scd2_merge_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change of the second batch becomes a version."""
    work = scratch_path(spark, "scd2_merge_all_versions")
    return _shown(SCD2.merge_every_change(_dim(spark, sf_dir), fx.slice2(spark, sf_dir), work))


@query("scd2_history_view", f"{RUNS_SQL} {MERGED_SQL}")
def scd2_history_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(SCD2.history_view(_merged(spark, sf_dir)))


BOUNDS = [fx.BOOKMARK, datetime(1999, 6, 1), datetime(2000, 6, 1), None]


def _refreshed(spark: SparkSession, sf_dir: str, name: str, kind) -> StoredDimension:
    """A stored dimension after its first load and three refreshes."""
    dim = StoredDimension(scratch_path(spark, name), kind, buckets=8)
    refresh_dimension(dim, fx.run1(spark, sf_dir), "r0", fx.BOOKMARK)
    for number, (lo, hi) in enumerate(zip(BOUNDS, BOUNDS[1:]), 1):
        batch = incremental_slice(fx.slice2(spark, sf_dir), SCD2.ts_col, lo, hi)
        refresh_dimension(dim, batch, f"r{number}", AS_OF)
    return dim


@query("scd2_stored_refresh", f"{RUNS_SQL}, {ALL_VERSIONS_SQL}")
def scd2_stored_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge as a stored dimension: first load, three refreshes, read back."""
    return _shown(read_dimension(spark, _refreshed(spark, sf_dir, "scd2_stored_refresh", SCD2)))


@query("scd2_late_splice", f"WITH log AS ({CHANGES_SQL}), {VERSIONS_SQL}")
def scd2_late_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All changes in three batches by status, so that two of them fall between stored versions."""
    dim = StoredDimension(scratch_path(spark, "scd2_late_splice"), SCD2, buckets=8)
    log, status = fx.changes(spark, sf_dir), F.col("order_status")
    batches = [status.isNull() | ~status.isin("F", "P"), status == "P", status == "F"]
    for number, chosen in enumerate(batches):
        refresh_dimension(dim, log.filter(chosen), f"r{number}", AS_OF)
    return _shown(read_dimension(spark, dim))


@query(
    "scd1_stored_refresh",
    f"""{LATEST_SQL}
SELECT {BASE} FROM newest""",
)
def scd1_stored_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = Type1(BATCH_KEYS, BATCH_ORDER)
    return current_rows(spark, _refreshed(spark, sf_dir, "scd1_stored_refresh", kind))


@query(
    "scd3_stored_refresh",
    f"""{RUNS_SQL},
batches AS (
    SELECT *, CASE WHEN last_modified_ts <= TIMESTAMP '1998-04-15' THEN 0
                   WHEN last_modified_ts <= TIMESTAMP '1999-06-01' THEN 1
                   WHEN last_modified_ts <= TIMESTAMP '2000-06-01' THEN 2 ELSE 3 END AS batch
    FROM changes),
loaded AS (
    SELECT * FROM batches
    QUALIFY row_number() OVER (
        PARTITION BY customer_id, batch ORDER BY last_modified_ts DESC, order_id DESC) = 1),
steps AS (
    SELECT *, lag(order_status) OVER w AS before_status,
           last_value(order_priority IGNORE NULLS) OVER (
               PARTITION BY customer_id ORDER BY batch
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS priority
    FROM loaded WINDOW w AS (PARTITION BY customer_id ORDER BY batch)),
moves AS (
    SELECT *, last_value(CASE WHEN before_status <> order_status THEN before_status END IGNORE NULLS) OVER (
        PARTITION BY customer_id ORDER BY batch
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS previous FROM steps)
SELECT customer_id, order_id, priority AS order_priority, last_modified_ts,
       order_status AS order_status_current, previous AS order_status_previous
FROM moves QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY batch DESC) = 1""",
)
def scd3_stored_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = Type3(BATCH_KEYS, "order_status", BATCH_ORDER)
    return current_rows(spark, _refreshed(spark, sf_dir, "scd3_stored_refresh", kind))


@query(
    "scd3_initial",
    f"""{LATEST_SQL}
SELECT customer_id, order_id, order_priority, last_modified_ts,
       order_status AS order_status_current, cast(NULL AS varchar) AS order_status_previous
FROM newest""",
)
def scd3_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd3_initial(_newest(spark, sf_dir), "order_status")


SCD3_SQL = """
SELECT coalesce(b.customer_id, a.customer_id) AS customer_id,
       coalesce(b.order_id, a.order_id) AS order_id,
       coalesce(b.order_priority, a.order_priority) AS order_priority,
       coalesce(b.last_modified_ts, a.last_modified_ts) AS last_modified_ts,
       coalesce(b.order_status, a.order_status) AS order_status_current,
       CASE WHEN a.order_status <> b.order_status THEN a.order_status END
           AS order_status_previous
FROM run1 a FULL JOIN run2 b ON a.customer_id = b.customer_id"""


def _type3(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = scd3_initial(fx.run1(spark, sf_dir), "order_status")
    return scd3_merge(dim, fx.slice2(spark, sf_dir), BATCH_KEYS, "order_status", BATCH_ORDER)


@query("scd3_merge", f"{RUNS_SQL} {SCD3_SQL}")
def scd3_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type3(spark, sf_dir)


@query(
    "scd_summary_union",
    f"""{RUNS_SQL}, type3 AS ({SCD3_SQL})
SELECT 'TYPE1' AS scd_type, customer_id, order_status AS current_status,
       NULL AS previous_status, last_modified_ts AS last_updated
FROM (SELECT * FROM run1 UNION ALL SELECT * FROM run2)
QUALIFY row_number() OVER (
    PARTITION BY customer_id ORDER BY last_modified_ts DESC, order_id DESC) = 1
UNION ALL
SELECT 'TYPE2_CURRENT', customer_id, order_status, NULL, last_modified_ts FROM ({VIEW_SQL})
UNION ALL
SELECT 'TYPE3', customer_id, order_status_current, order_status_previous, last_modified_ts
FROM type3""",
)
def scd_summary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    type1 = scd1_merge(fx.run1(spark, sf_dir), fx.run2(spark, sf_dir), BATCH_KEYS, BATCH_ORDER)
    type2 = SCD2.current_view(_merged(spark, sf_dir))
    nothing = F.lit(None).cast("string")

    def labelled(df: DataFrame, label: str, status: str, previous) -> DataFrame:
        return df.select(
            F.lit(label).alias("scd_type"),
            "customer_id",
            F.col(status).alias("current_status"),
            previous.alias("previous_status"),
            F.col("last_modified_ts").alias("last_updated"),
        )

    return stack(
        labelled(type1, "TYPE1", "order_status", nothing),
        labelled(type2, "TYPE2_CURRENT", "order_status", nothing),
        labelled(
            _type3(spark, sf_dir), "TYPE3", "order_status_current", F.col("order_status_previous")
        ),
    ).orderBy("scd_type", "customer_id")


@query(
    "joined_update",
    f"""{RUNS_SQL}
SELECT {_prefixed("a")},
       CASE WHEN b.customer_id IS NOT NULL AND {MOVED_SQL} THEN b.last_modified_ts END
           AS closed_at,
       NOT (b.customer_id IS NOT NULL AND {MOVED_SQL}) AS is_current
FROM run1 a LEFT JOIN run2 b ON a.customer_id = b.customer_id""",
)
def joined_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update through a join: both sides hold one row per key, so no key is hot."""
    incoming = fx.run2(spark, sf_dir).select(
        "customer_id",
        F.lit(True).alias("found"),
        F.col("order_status").alias("new_status"),
        F.col("order_priority").alias("new_priority"),
        F.col("last_modified_ts").alias("new_ts"),
    )
    dim = fx.run1(spark, sf_dir).withColumns(
        {"closed_at": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True)}
    )
    moved = F.col("found") & any_differs(
        [
            (F.col("order_status"), F.col("new_status")),
            (F.col("order_priority"), F.col("new_priority")),
        ]
    )
    matched = dim.join(incoming, "customer_id", "left")
    closed = {"closed_at": F.col("new_ts"), "is_current": F.lit(False)}
    return update_where(matched, moved, closed).select(*dim.columns)


@query(
    "fact_as_of_customer",
    f"""WITH log AS ({CHANGES_SQL}),
versions AS (SELECT *, row_number() OVER (
        PARTITION BY customer_id, effective_from ORDER BY version DESC) AS place
    FROM (WITH {VERSIONS_SQL.strip()})),
facts AS (
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS customer_id, l_shipdate AS shipped_at
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT f.order_id, f.line_number, f.customer_id, f.shipped_at, v.order_status, v.order_priority, v.version
FROM facts f LEFT JOIN versions v ON v.customer_id = f.customer_id AND v.place = 1
    AND v.effective_from <= f.shipped_at
    AND (v.is_current OR f.shipped_at < cast(v.effective_to AS timestamp))""",
)
def fact_as_of_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with the customer's version that was valid when it was shipped."""
    work = scratch_path(spark, "fact_as_of_customer")
    log = fx.changes(spark, sf_dir)
    rows = log.withColumns({"_stored": F.lit(False), "_base": F.lit(None).cast("long")})
    versions = SCD2.spliced(rows, log.columns, f"{work}/versions").filter(OPENS)
    lines = fx.table(spark, sf_dir, "lineitem").join(
        fx.table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    facts = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_shipdate").alias("shipped_at"),
    )
    take = ["order_status", "order_priority", "version"]
    return as_of_join(facts, versions, BATCH_KEYS, "shipped_at", "effective_from", "effective_to", take, f"{work}/facts", seq="version")
