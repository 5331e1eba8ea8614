"""JDBC settings. No database is started here: a recorder stands in for Spark's reader."""

from __future__ import annotations

import pytest

from tidemark.sinks import jdbc as jdbc_sink
from tidemark.sinks.jdbc import rewrite_jdbc, write_jdbc, write_tables
from tidemark.sources.jdbc import Split, read_jdbc, read_tables

OPTIONS = {"url": "jdbc:example:db", "user": "u", "password": "p", "driver": "d"}


class Recorder:
    """Stands in for ``spark.read`` and ``df.write`` and keeps what it is given."""

    def __init__(self):
        self.settings: dict[str, object] = {}
        self.saved: list[dict[str, object]] = []

    read = write = property(lambda self: self)

    def format(self, name):
        self.settings["format"] = name
        return self

    def mode(self, name):
        self.settings["mode"] = name
        return self

    def option(self, key, value):
        self.settings[key] = value
        return self

    def options(self, **values):
        self.settings.update(values)
        return self

    def load(self):
        return dict(self.settings)

    def save(self):
        self.saved.append(dict(self.settings))

    def jdbc(self, url, table, predicates, properties):
        return {"url": url, "dbtable": table, "predicates": predicates, **properties}


def test_table_and_query():
    got = read_jdbc(Recorder(), OPTIONS, table="customers")
    assert got["dbtable"] == "customers" and got["format"] == "jdbc" and got["user"] == "u"
    assert got["preferTimestampNTZ"] == "true"
    got = read_jdbc(Recorder(), OPTIONS, query="SELECT 1 AS x")
    assert got["dbtable"] == "(SELECT 1 AS x) AS t"
    with pytest.raises(ValueError):
        read_jdbc(Recorder(), OPTIONS)
    with pytest.raises(ValueError):
        read_jdbc(Recorder(), OPTIONS, table="a", query="b")


def test_parallel_reads():
    split = Split("order_id", "1", "1000000", 64)
    got = read_jdbc(Recorder(), OPTIONS, table="orders", split=split)
    assert got["partitionColumn"] == "order_id" and got["numPartitions"] == "64"
    got = read_jdbc(Recorder(), OPTIONS, table="orders", predicates=["id < 5", "id >= 5"])
    assert got["predicates"] == ["id < 5", "id >= 5"] and got["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        read_jdbc(Recorder(), OPTIONS, table="orders", split=split, predicates=["x"])


def test_several_tables():
    got = read_tables(Recorder(), OPTIONS, ["customers", "orders"])
    assert {name: t["dbtable"] for name, t in got.items()} == {
        "customers": "customers",
        "orders": "orders",
    }


def test_overwrite_keeps_the_declared_table():
    frame = Recorder()
    write_jdbc(frame, OPTIONS, "dim_customer", writers=16)
    (saved,) = frame.saved
    assert saved["truncate"] == "true" and saved["mode"] == "overwrite"
    assert saved["batchsize"] == "5000" and saved["numPartitions"] == "16"


def test_rewrite_reads_everything_before_the_table_is_emptied(spark, monkeypatch):
    """The written frame must not depend on the overwritten table any more."""
    written = []
    monkeypatch.setattr(
        jdbc_sink, "write_jdbc", lambda df, options, table, **kw: written.append((df, kw))
    )
    df = spark.range(3).filter("id > 0")
    rewrite_jdbc(df, OPTIONS, "cdc_tracking")
    ((settled, settings),) = written
    assert settings["mode"] == "overwrite" and settled.exceptAll(df).isEmpty()
    assert "Range" not in settled._jdf.queryExecution().analyzed().toString()


def test_tables_are_written_in_order():
    frame = Recorder()
    write_tables({"dim_customer": frame, "fact_sales": frame}, OPTIONS, mode="append")
    assert [s["dbtable"] for s in frame.saved] == ["dim_customer", "fact_sales"]
    assert {s["mode"] for s in frame.saved} == {"append"}
