"""The command line on file sources, session settings and the declared star schema."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest

from pyspark.sql import Window, functions as F

from tests.seeds import model
from tidemark import __main__ as command_line
from tidemark.__main__ import parser, read_model, run, source_options
from tidemark.operators.numbering import number_rows
from tidemark.plans.star_load import build_star, publish_star, read_star
from tidemark.plans.star_schema import NATURAL_KEYS, conform, missing_values, star_schema
from tidemark.operators.quality import (
    duplicate_grain,
    null_counts,
    referential_integrity,
    row_counts,
    uniqueness,
)
from tidemark.operators.latest import latest_per_key
from tidemark.operators.update import fill_defaults, update_where
from tidemark.sinks.tables import append_rows
from tidemark.session import MIB, scratch_path, settings_for, settle


@pytest.fixture(scope="module")
def oltp(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("oltp")
    for name, df in model(spark).items():
        df.write.parquet(str(root / ("order_items" if name == "items" else name)))
    return root


def test_load_job(spark, oltp, tmp_path):
    words = [
        "load", "--name", "orders", "--format", "parquet", "--option", f"path={oltp}/orders",
        "--cdc-column", "order_ts", "--landing", str(tmp_path), "--as-of", "2024-03-01",
    ]
    first = [*words, "--upper-bound", "2024-02-02T00:00:00"]
    assert run(spark, parser().parse_args(first)) == "orders: 2 rows, bookmark 2024-02-01 12:40:00"
    assert run(spark, parser().parse_args(words)) == "orders: 4 rows, bookmark 2024-02-04 11:30:00"
    assert run(spark, parser().parse_args(words)) == "orders: 0 rows, bookmark 2024-02-04 11:30:00"


def test_load_job_by_number_with_rows_set_aside(spark, tmp_path):
    words = [
        "load", "--name", "n", "--format", "parquet", "--option", f"path={tmp_path}/rows", "--cdc-column", "seq",
        "--landing", f"{tmp_path}/landing", "--as-of", "2024-03-01", "--quarantine", "--overlap", "2",
    ]
    spark.createDataFrame([(1, 5), (2, 8), (3, None)], "id int, seq long").write.parquet(f"{tmp_path}/rows")
    told = [run(spark, parser().parse_args([*words, *more])) for more in (["--upper-bound", "5"], [], [])]
    assert told == ["n: 1 rows, 1 set aside, bookmark 5", "n: 2 rows, bookmark 8", "n: 0 rows, bookmark 8"]


def test_star_job(spark, oltp, tmp_path):
    words = [
        "star", "--format", "parquet", "--tables", str(oltp), "--target", str(tmp_path),
        "--release", "r1", "--as-of", "2024-03-01", "--iso-weeks",
    ]
    run(spark, parser().parse_args(words))
    stored = read_star(spark, str(tmp_path))
    assert {n: df.count() for n, df in stored.tables().items()} == {
        "dim_customer": 5,
        "dim_product": 5,
        "dim_date": 4,
        "fact_sales": 10,
    }
    assert stored.dim_date.filter("date_key = 20240201").first().day_of_week == 4
    for name, df in stored.tables().items():
        shaped = conform(df, name)
        assert shaped.schema.simpleString() == star_schema(name).simpleString()
        assert missing_values(shaped, name).filter("null_count > 0").isEmpty()
        assert duplicate_grain(shaped, NATURAL_KEYS[name]).isEmpty()


def test_secrets_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("DB_PASSWORD", "s3cret")
    args = parser().parse_args(
        ["star", "--format", "jdbc", "--option", "url=jdbc:x:y", "--secret",
         "password=DB_PASSWORD", "--target", "t", "--release", "r"]
    )
    assert source_options(args) == {"url": "jdbc:x:y", "password": "s3cret"}
    with pytest.raises(SystemExit):
        parser().parse_args(["star", "--format", "jdbc", "--option", "nonsense", "--target", "t"])


def test_quality_reports(spark):
    m = model(spark)
    doubled = m["items"].unionAll(m["items"].filter("order_id = 1001"))
    found = uniqueness(
        {"items": (m["items"], ["order_id", "line_number"]), "doubled": (doubled, ["order_id", "line_number"])}
    )
    assert {r.check_name: (r.repeated_keys, r.surplus_rows) for r in found.collect()} == {
        "items": (0, 0),
        "doubled": (2, 2),
    }
    orders = m["orders"].filter("order_id <> 1006")
    report = referential_integrity({"items": (m["items"], orders, "order_id", "order_id")})
    assert tuple(report.first()) == ("items", 1, 2)
    nulls = null_counts(m["products"], ["product_id", "is_active"])
    assert {r.column_name: r.null_count for r in nulls.collect()} == {"product_id": 0, "is_active": 1}
    counts = row_counts({"orders": m["orders"], "items": m["items"]})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"orders": 6, "items": 10}


def test_null_foreign_key_is_not_an_orphan(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,)], "pk int")
    report = referential_integrity({"x": (child, parent, "fk", "pk")})
    assert tuple(report.first()) == ("x", 1, 2)


def test_updates_and_defaults(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5), (3, "a", 6)], "id int, v string, n long")
    got = update_where(df, F.col("v") == "a", {"v": F.lit("b"), "n": F.col("n") + 1})
    assert sorted(map(tuple, got.collect())) == [(1, "b", None), (2, None, 5), (3, "b", 7)]
    filled = fill_defaults(df, {"n": 1, "v": "none"})
    assert sorted(map(tuple, filled.collect())) == [(1, "a", 1), (2, "none", 5), (3, "a", 6)]
    assert filled.dtypes == df.dtypes


def test_append_matches_columns_by_name(spark, tmp_path):
    spark.sql(f"CREATE TABLE appended (id INT, name STRING) USING parquet LOCATION '{tmp_path}/t'")
    try:
        append_rows(spark.createDataFrame([("x", 1)], "name string, id long"), "appended")
        append_rows(spark.createDataFrame([(2, "y")], "id int, name string"), "appended")
        assert sorted(map(tuple, spark.table("appended").collect())) == [(1, "x"), (2, "y")]
    finally:
        spark.sql("DROP TABLE appended")


def test_rows_with_maps_can_be_ranked(spark):
    rows = [(1, 5, {"a": 1}), (1, 7, {"b": 2})]
    df = spark.createDataFrame(rows, "k int, at int, tags map<string,int>")
    assert latest_per_key(df, ["k"], ["at"]).first().tags == {"b": 2}


def test_settings_grow_with_the_shuffle():
    assert settings_for(10 * MIB)["spark.sql.shuffle.partitions"] == "200"
    assert settings_for(20 * 1024**4)["spark.sql.shuffle.partitions"] == "163840"


def test_scratch_follows_the_cluster_setting(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second
    df = spark.range(3)
    assert settle(df, "three").exceptAll(df).isEmpty()


def test_as_of_is_optional():
    words = ["load", "--name", "n", "--format", "csv", "--cdc-column", "c", "--landing", "l"]
    assert parser().parse_args(words).as_of is None
    words += ["--as-of", "2024-03-01T10:00:00"]
    assert parser().parse_args(words).as_of == datetime(2024, 3, 1, 10)


def test_a_faulty_star_is_not_published(spark, oltp, tmp_path, monkeypatch):
    words = ["star", "--format", "parquet", "--tables", str(oltp), "--target", str(tmp_path), "--as-of", "2024-03-01"]
    run(spark, parser().parse_args([*words, "--release", "r1"]))
    good = build_star(*read_model(spark, parser().parse_args([*words, "--release", "x"])))
    same_key = replace(good, dim_product=good.dim_product.withColumn("product_key", F.lit(1).cast("long")))
    with pytest.raises(ValueError, match="collide"):
        publish_star(same_key, str(tmp_path), "r2", datetime(2024, 3, 2))
    lacking = replace(good, fact_sales=good.fact_sales.drop("net_amount"))
    with pytest.raises(ValueError, match="net_amount"):
        publish_star(lacking, str(tmp_path), "r3", datetime(2024, 3, 2))
    assert read_star(spark, str(tmp_path)).dim_product.select("product_key").distinct().count() == 5
    orphaned = replace(good, dim_product=good.dim_product.limit(4))
    report = publish_star(orphaned, str(tmp_path), "r4", datetime(2024, 3, 2))
    assert report.row_counts["dim_product"] == 4 and report.orphan_rows["dim_product"] > 0
    with pytest.raises(ValueError, match="before the newest"):
        publish_star(good, str(tmp_path), "r5", datetime(2024, 3, 1))


def test_command_line_splits_and_sizes():
    words = ["star", "--format", "jdbc", "--target", "t", "--release", "r", "--split", "orders=order_id,1,900,64", "--shuffled-bytes", "9"]
    args = parser().parse_args(words)
    assert dict(args.split)["orders"].options()["numPartitions"] == "64" and args.shuffled_bytes == 9
    with pytest.raises(SystemExit):
        parser().parse_args([*words, "--split", "orders=order_id"])


def test_database_tables_are_read_in_parallel(monkeypatch):
    seen = {}
    monkeypatch.setattr(command_line, "read_jdbc", lambda spark, options, **kw: seen.update({kw["table"]: kw["split"]}))
    args = parser().parse_args(["star", "--format", "jdbc", "--target", "t", "--release", "r", "--split", "orders=order_id,1,900,64"])
    read_model(None, args)
    assert sorted(seen) == sorted(["customers", "categories", "products", "orders", "order_items"])
    assert seen["orders"].partitions == 64 and seen["products"] is None


def test_numbering_spreads_a_hot_key(spark, tmp_path):
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, i long").repartition(5)
    got = number_rows(df, [F.col("i").desc()], "n", str(tmp_path / "all"), by=["k"], partitions=8)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("i"))).cast("long"))
    assert got.exceptAll(want).isEmpty() and got.count() == 3000
    stored = spark.read.parquet(str(tmp_path / "all")).filter("k = 'hot'")
    assert stored.select("__part").distinct().count() > 3
    single = number_rows(df, ["i"], "n", str(tmp_path / "one"), partitions=4)
    assert [r.n for r in single.orderBy("i").select("n").collect()] == list(range(1, 3001))
