"""Normalized tables → stored star schema."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.dimensions import dim_customer, dim_date, dim_product
from tidemark.operators.facts import fact_sales
from tidemark.operators.key_registry import DIGITS, Keys, extended
from tidemark.operators.quality import references_between, row_counts, uniqueness
from tidemark.plans.star_schema import NATURAL_KEYS, conform, star_schema
from tidemark.session import settle
from tidemark.sinks.releases import latest_release, publish, read_current

# Dimensions come before the fact, for sinks that check the fact's references.
STAR_TABLES = ("dim_customer", "dim_product", "dim_date", "fact_sales")


@dataclass(frozen=True)
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in STAR_TABLES}


def build_star(
    customers: DataFrame,
    categories: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    customer_attributes: list[str] | None = None,
    product_attributes: list[str] | None = None,
    iso_weeks: bool = False,
    keys: Keys | None = None,
) -> Star:
    """The star schema as lazy frames; ``keys`` settles keys whose hashes collide."""
    customer, product = dim_customer(customers, customer_attributes), dim_product(products, categories, product_attributes)
    if keys:
        customer = keys.add(customer, "customer_id", "customer_key")
        product = keys.add(product, "product_id", "product_key")
    return Star(customer, product, dim_date(orders, "order_ts", iso_weeks), fact_sales(items, orders, keys or Keys()))


def registered_keys(spark: SparkSession, root: str, naturals: dict[str, DataFrame], digits: int = DIGITS) -> Keys:
    """Keys for the next release under ``root``: those of the current one stay as they are.

    ``naturals`` gives the source frame of ``customer_id`` and ``product_id``. The registries
    are settled, since the dimension, the fact and the next release must agree on them.
    """
    found = {}
    current = latest_release(spark, root) is not None
    for natural, source in naturals.items():
        dim, key = KEYED[natural]
        stored = registry = None
        if current:
            stored, registry = read_current(spark, root, dim, _registry(natural))
            stored = stored.select(F.col(natural).alias("natural"), F.col(key).alias("key"))
        names = source.select(F.col(natural).alias("natural")).distinct()
        found[natural] = settle(extended(names, registry, stored, digits), _registry(natural))
    return Keys(digits, found)


def _registry(natural: str) -> str:
    return f"registry_{natural}"


# Hashed keys and references of the star.
SURROGATE_KEYS = {"dim_customer": "customer_key", "dim_product": "product_key"}
KEYED = {"customer_id": ("dim_customer", "customer_key"), "product_id": ("dim_product", "product_key")}
REFERENCES = [("customer_key", "dim_customer"), ("product_key", "dim_product"), ("date_key", "dim_date")]


@dataclass(frozen=True)
class StarReport:
    """What the checks of a release found; ``row_counts`` is by table."""

    row_counts: dict[str, int]
    repeated_grain: dict[str, int]
    orphan_rows: dict[str, int]


def check_star(tables: dict[str, DataFrame]) -> StarReport:
    """Check written star tables. Missing columns and colliding hashed keys raise.

    Repeated grain and orphans are the source's business and are reported. Every report is a
    few numbers from an aggregation.
    """
    for name, df in tables.items():
        needed = [*NATURAL_KEYS[name], *([SURROGATE_KEYS[name]] if name in SURROGATE_KEYS else [])]
        if name == "fact_sales":
            needed = star_schema(name).names
        if missing := [c for c in needed if c not in df.columns]:
            raise ValueError(f"{name} lacks {missing}")
    keys = uniqueness({n: (tables[n].select(k, *NATURAL_KEYS[n]).distinct(), [k]) for n, k in SURROGATE_KEYS.items()})
    if shared := [r.check_name for r in keys.filter("repeated_keys > 0").collect()]:
        raise ValueError(f"hashed keys collide in {shared}")
    grain = uniqueness({n: (df, NATURAL_KEYS[n]) for n, df in tables.items()}).collect()
    fact = tables["fact_sales"]
    found = [references_between(fact, key, tables[dim], key, dim, None).first() for key, dim in REFERENCES]
    return StarReport(
        {r.table_name: r.row_count for r in row_counts(tables).collect()},
        {r.check_name: r.surplus_rows for r in grain},
        {r.check_name: r.orphan_rows for r in found},
    )


def publish_star(
    star: Star, root: str, release: str, at: datetime, declared: bool = False, keys: Keys | None = None
) -> StarReport:
    """Store all four tables as one release, so that keys always find their dimension.

    The tables are checked where they were written, before readers can see them; a failed
    check leaves readers on the old release. ``declared`` first brings every table into its
    declared columns and types, where a missing column is an error. The registries of ``keys``,
    with which the star was built, become part of the release.
    """
    tables = star.tables()
    if declared:
        tables = {name: conform(df, name) for name, df in tables.items()}
    reports: list[StarReport] = []
    registries = {_registry(n): df for n, df in keys.registries.items()} if keys else {}

    def check(written: dict[str, DataFrame]) -> None:
        reports.append(check_star({name: written[name] for name in tables}))

    publish({**tables, **registries}, root, release, at, check)
    return reports[0]


def read_star(spark: SparkSession, root: str) -> Star:
    """The stored star. Queries on it read the fact once instead of deriving it again."""
    return Star(*read_current(spark, root, *STAR_TABLES))
