"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A document descends from the root. At every node each child draws ``-ln(u) / weight``, with
``u`` hashed from the document's id and the child's name, and the least draw wins, so a child
is chosen in proportion to its weight (the sum of the weights below it). A draw depends on
its own child only: where the weight of a child rises, documents move into that subtree; where
it falls, they move out of it; no document moves between two children of unchanged weight, and
subtrees whose weights stay keep the order of their documents.

A shard that is added takes a region of its own (``with_shard``). It is then the only shard
whose ancestors' weights change, so documents move into the new shard and nowhere else: the law
``key``. A shard that joins an existing rack instead (``in_rack``) leaves the other regions'
documents to that region, but may move documents between the shards of its own region.

Everything is SQL functions: a descent is a projection without a shuffle. Only numbering the
rows of a shard shuffles, and there only ids, sizes and checksums, in range partitions, so a
shard with a third of all rows is many tasks' work. The tree is part of the plan; its size is
that of the list of shards.

Edge cases: a null text has size 8 and the checksum 0 of the empty text; rows without an id
share one key; rows of equal id go to one shard; wholly equal rows take any of their slots; the
tree must have a shard and weights above 0; an empty table gives an empty result. Extra
columns are kept by ``assign`` and ``write_shards``, whose own columns may be renamed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import Scratch
from tidemark.operators.numbering import number_rows

LAW = "key"
EXTRA_BYTES = 8
DIGITS = 15  # hex digits of a draw: 60 bits


@dataclass(frozen=True)
class Tree:
    """Shards as ``(region, rack, shard, weight)``; shards are numbered from 0 without gaps."""

    shards: tuple[tuple[str, str, int, float], ...]

    def __post_init__(self):
        if sorted(s for _, _, s, _ in self.shards) != list(range(len(self.shards))) or not self.shards:
            raise ValueError("shards must be numbered from 0 without gaps")
        if not all(0 < w < float("inf") for *_, w in self.shards):
            raise ValueError("a shard's weight must be a number above 0")

    @staticmethod
    def even(regions: int, racks: int, shards: int) -> Tree:
        """So many regions of so many racks of so many shards, all of weight 1."""
        places = [(f"region-{a}", f"rack-{b}") for a in range(regions) for b in range(racks) for _ in range(shards)]
        return Tree(tuple((region, rack, n, 1.0) for n, (region, rack) in enumerate(places)))

    def with_shard(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own."""
        number = len(self.shards)
        return Tree((*self.shards, (f"region-of-{number}", "rack-0", number, weight)))

    def in_rack(self, region: str, rack: str, weight: float = 1.0) -> Tree:
        """One more shard in a given rack."""
        return Tree((*self.shards, (region, rack, len(self.shards), weight)))

    def reweighted(self, shard: int, weight: float) -> Tree:
        return Tree(tuple((a, b, n, weight if n == shard else w) for a, b, n, w in self.shards))

    def levels(self) -> list[list[list[tuple[str, float, int]]]]:
        """Per level and node the children as (name, weight, number of the child in its level)."""
        sums: list[dict[tuple, float]] = [{}, {}, {}, {}]
        for region, rack, shard, weight in self.shards:
            path = (region, rack, shard)
            for depth in range(4):
                sums[depth][path[:depth]] = sums[depth].get(path[:depth], 0.0) + weight
        levels = []
        for depth in range(3):
            numbers = {path: path[2] if depth == 2 else i for i, path in enumerate(sums[depth + 1])}
            levels.append(
                [
                    [("/".join(map(str, path)), weight, numbers[path]) for path, weight in sums[depth + 1].items() if path[:depth] == node]
                    for node in sums[depth]
                ]
            )
        return levels


def drawn(key: Column, name: Column, weight: Column) -> Column:
    """The child's draw: exponential with the rate ``weight``."""
    digest = F.substring(F.md5(F.concat_ws("|", key, name).cast("binary")), 1, DIGITS)
    unit = (F.conv(digest, 16, 10).cast("bigint") + 1).cast("double") / F.lit(float(16**DIGITS))
    return -F.ln(unit) / weight


def shard_of(tree: Tree, doc_id: Column) -> Column:
    """The shard of an id: three draws among the children of the node reached."""
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    node = F.lit(0)
    for nodes in tree.levels():
        children = F.array(
            *[F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight"), F.lit(i).alias("number")) for n, w, i in c]) for c in nodes]
        )
        draws = F.transform(
            F.get(children, node),
            lambda c: F.struct(drawn(key, c["name"], c["weight"]).alias("draw"), c["number"].alias("number")),
        )
        node = F.array_min(draws)["number"]
    return node


def assign(docs: DataFrame, tree: Tree, doc_id: str = "doc_id", name: str = "shard") -> DataFrame:
    """The documents with their shard; no shuffle."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name!r}; give another name")
    return docs.select(*[docs[f"`{c}`"] for c in docs.columns], shard_of(tree, docs[f"`{doc_id}`"]).alias(name))


def write_shards(docs: DataFrame, tree: Tree, path: str, doc_id: str = "doc_id", name: str = "shard") -> None:
    """One folder of Parquet files per shard, each in the order of the ids.

    Range partitions over shard and id give every task rows of few shards, and a large shard
    as many files as it needs.
    """
    rows = assign(docs, tree, doc_id, name)
    n = max(len(tree.shards), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(n, F.col(f"`{name}`"), F.col(f"`{doc_id}`"))
    rows.sortWithinPartitions(F.col(f"`{name}`"), F.col(f"`{doc_id}`")).write.partitionBy(name).parquet(path)


def shard_rows(docs: DataFrame, tree: Tree, grown: Tree, scratch: Scratch) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard per row; slots count from 0."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(data) + EXTRA_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    rows = rows.select(
        "*", shard_of(tree, F.col("doc_id")).alias("shard"), shard_of(grown, F.col("doc_id")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("tie"),
    )
    numbered = number_rows(rows, ["doc_id", "size", "text_crc32", "tie"], "n", scratch.path("numbered"), by=["shard"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("n") - 1).alias("slot"), "grown_shard")


# 24 shards: two regions of three racks of four.
SHARDS = Tree.even(2, 3, 4)


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = shard_rows(docs, SHARDS, SHARDS.with_shard(), Scratch(spark, "op13"))
    return rows.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


def _nodes_sql(tree: Tree, name: str) -> str:
    rows = [
        f"({depth}, {parent}, '{child}', {weight!r}::DOUBLE, {number})"
        for depth, nodes in enumerate(tree.levels())
        for parent, children in enumerate(nodes)
        for child, weight, number in children
    ]
    return f"{name}(depth, parent, name, weight, number) AS (VALUES {', '.join(rows)})"


def _descent_sql(nodes: str, out: str) -> str:
    draw = (
        f"-ln((('0x' || substr(md5(key || '|' || name), 1, {DIGITS}))::BIGINT + 1)::DOUBLE / {float(16**DIGITS)!r}::DOUBLE) / weight"
    )
    steps, above = [], "SELECT key, 0 AS node FROM ids"
    for depth in range(3):
        steps.append(
            f"{out}{depth} AS (SELECT key, arg_min(number, {draw}) AS node FROM ({above}) JOIN {nodes}"
            f" ON depth = {depth} AND parent = node GROUP BY key)"
        )
        above = f"SELECT key, node FROM {out}{depth}"
    return ", ".join(steps)


def shards_sql(tree: Tree = SHARDS) -> str:
    """Reference SQL. The checksum goes bytewise over a table that a rule builds."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    table = "SELECT n, 0 AS k, n AS c FROM range(256) AS r(n)"
    return f"""
WITH RECURSIVE {_nodes_sql(tree, "tree")}, {_nodes_sql(tree.with_shard(), "grown")},
bits(n, k, c) AS ({table} UNION ALL SELECT n, k + 1, {step} FROM bits WHERE k < 8),
crc AS (SELECT list(c::UBIGINT ORDER BY n) AS t FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, coalesce(cast(doc_id AS varchar), '') AS key, hex(encode(coalesce(text, ''))) AS h FROM documents
), ids AS (
  SELECT DISTINCT key FROM d
), {_descent_sql("tree", "small")}, {_descent_sql("grown", "large")},
rows AS (
  SELECT doc_id, (length(h) // 2 + {EXTRA_BYTES})::BIGINT AS size, s.node AS shard, l.node AS grown_shard,
         xor(list_reduce(
           list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::UBIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1]), 4294967295::UBIGINT
         ), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM d JOIN small2 s USING (key) JOIN large2 l USING (key), crc
)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
FROM rows
"""
