"""Command line for the two recurring jobs.

    python -m tidemark load --name orders --format jdbc --option url=… --option dbtable=orders \\
        --secret password=DB_PASSWORD --cdc-column last_modified --landing /data/landing

    python -m tidemark star --format parquet --tables /data/oltp --target /data/star --release r1

Secrets are named, not given: ``--secret password=DB_PASSWORD`` takes the value from the
environment variable ``DB_PASSWORD``. ``--split orders=order_id,1,900000000,256`` reads a
database table in parallel; for ``load`` the name is that of the source. ``--shuffled-bytes``
sizes the shuffles. Times are UTC; without ``--as-of`` the run's time is the clock's in UTC.
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DataType, DateType

from tidemark.plans.incremental_job import Landing, is_stamp, parsed, run_incremental
from tidemark.plans.star_load import build_star, publish_star
from tidemark.session import build_session, settings_for
from tidemark.sources.files import FORMATS
from tidemark.sources.jdbc import Split, read_jdbc

MODEL = ("customers", "categories", "products", "orders", "order_items")


def pair(text: str) -> tuple[str, str]:
    key, sign, value = text.partition("=")
    if not sign or not key:
        raise argparse.ArgumentTypeError(f"{text!r} is not of the form key=value")
    return key, value


def split_of(text: str) -> tuple[str, Split]:
    name, plan = pair(text)
    parts = plan.split(",")
    if len(parts) != 4 or not parts[3].isdigit():
        raise argparse.ArgumentTypeError(f"{text!r} is not of the form table=column,lower,upper,partitions")
    return name, Split(parts[0], parts[1], parts[2], int(parts[3]))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="land what changed since the last run")
    load.add_argument("--name", required=True, help="source name in the bookmark log")
    load.add_argument("--cdc-column", required=True)
    load.add_argument("--landing", required=True)
    load.add_argument("--landing-format", default="parquet", choices=FORMATS)
    load.add_argument("--upper-bound", help="in the form of the change column: a time, a date or a number")
    load.add_argument("--overlap", help="seconds for times, days for dates, else a number", default="0")
    load.add_argument("--quarantine", action="store_true", help="set rows without a change time aside")
    star = jobs.add_parser("star", help="build and publish the star schema")
    star.add_argument("--tables", help="folder of the normalized tables, for file formats")
    star.add_argument("--target", required=True)
    star.add_argument("--release", required=True)
    star.add_argument("--iso-weeks", action="store_true")
    for job in (load, star):
        job.add_argument("--format", required=True, help="a Spark source, such as jdbc or parquet")
        job.add_argument("--option", type=pair, action="append", default=[])
        job.add_argument("--secret", type=pair, action="append", default=[])
        job.add_argument("--as-of", type=datetime.fromisoformat, default=None)
        job.add_argument("--split", type=split_of, action="append", default=[])
        job.add_argument("--shuffled-bytes", type=int, default=None)
    return top


def overlap_of(text: str, kind: DataType) -> timedelta | int:
    """An overlap in the unit of the change column."""
    if is_stamp(kind):
        return timedelta(seconds=float(text))
    return timedelta(days=int(text)) if isinstance(kind, DateType) else int(text)


def source_options(args: argparse.Namespace) -> dict[str, str]:
    return dict(args.option) | {key: os.environ[name] for key, name in args.secret}


def read_source(spark: SparkSession, args: argparse.Namespace, name: str) -> DataFrame:
    """One table of the source; a database table in parallel where a split is given."""
    options = source_options(args)
    if args.format != "jdbc":
        return spark.read.format(args.format).options(**options).load(*([f"{args.tables}/{name}"] if args.job == "star" else []))
    query = options.pop("query", None)
    table = None if query else options.pop("dbtable", name)
    return read_jdbc(spark, options, table=table, query=query, split=dict(args.split).get(name))


def read_model(spark: SparkSession, args: argparse.Namespace) -> list[DataFrame]:
    """The five normalized tables, from a database or from one folder each."""
    return [read_source(spark, args, name) for name in MODEL]


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    if args.job == "load":
        source = read_source(spark, args, args.name)
        kind = source.schema[args.cdc_column].dataType
        done = run_incremental(
            spark,
            args.name,
            source,
            args.cdc_column,
            Landing(args.landing, args.landing_format),
            as_of,
            None if args.upper_bound is None else parsed(args.upper_bound, kind),
            overlap_of(args.overlap, kind),
            args.quarantine,
        )
        aside = f", {done.quarantined} set aside" if done.quarantined else ""
        return f"{done.source}: {done.rows} rows{aside}, bookmark {done.bookmark_after}"
    star = build_star(*read_model(spark, args), iso_weeks=args.iso_weeks)
    report = publish_star(star, args.target, args.release, as_of, declared=True)
    return f"{args.target}: release {args.release}, rows {report.row_counts}, orphans {report.orphan_rows}"


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    settings = settings_for(args.shuffled_bytes) if args.shuffled_bytes else {}
    named = {key.replace(".", "__"): value for key, value in settings.items()}
    print(run(build_session(f"tidemark-{args.job}", **named), args))


if __name__ == "__main__":
    main()
