"""Approximate nearest neighbours in balanced posting lists.

Fit: a bounded sample (the ``SAMPLE`` vectors that come first by a hash of their values) is
split again and again into balanced halves until a part holds at most ``list_size`` vectors'
share of the whole table; the means of the parts, settled by a few rounds of k-means on the
sample, are the centroids, at most ``MAX_LISTS``.
A neighbour graph over the centroids is searched best-first in memory; centroids and graph
are broadcast and their size is bounded by ``MAX_LISTS`` whatever the table's size.

Index: every vector goes to its nearest list and, near a boundary, to up to ``REPLICAS``
lists whose distance is within ``CLOSURE`` of the nearest. Lists that come out longer than
``BLOCK`` are split into blocks, so no task holds a longer piece.

Search: a query goes to its nearest list and every list whose centroid distance is within a ratio
of the mean over the ``REPLICAS`` nearest. The ratio is measured: ``TESTS`` sampled vectors look for their true neighbours
in the whole table, and the ratio is taken that reaches the share ``AIM`` of them. Each block
answers with its k nearest by exact distance, and the answers are merged by one aggregation.

Equal vectors are one vector with the k + 1 smallest of their ids: no answer needs more of
them, since they are equally far from every query. So a vector with a third of all rows is
one entry. Equal queries are searched once.

Edge cases: vectors that are null, zero, of another length than most, or hold null or
non-finite values take no part; null ids neither; repeated rows of an id count once; fewer
candidates than k give fewer rows; empty tables give an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import Scratch

SAMPLE = 20_000
MAX_LISTS = 4096
LIST_SIZE = 100
BLOCK = 1000
REPLICAS = 8
CLOSURE = 1.15
GROUP = 32
TESTS = 128
AIM = 0.95
GRAPH_DEGREE = 24
BEAM = 32
STEP = 4
WALK = 256
SETTLE = 6


@dataclass(frozen=True)
class Lists:
    centroids: np.ndarray
    graph: np.ndarray  # neighbours of each centroid, nearest first
    entries: np.ndarray  # centroids at which a search begins
    reach: float = 1.0  # ratio of distances within which lists are searched


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all of ``to``, good enough for ranking lists."""
    d = (points**2).sum(1)[:, None] - 2 * points @ to.T + (to**2).sum(1)[None, :]
    return np.maximum(d, 0)


def balanced_parts(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Split into halves along the direction between two far points until parts are small."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            done.append(part)
            continue
        own = points[part]
        a = own[np.argmax(((own - own.mean(0)) ** 2).sum(1))]
        b = own[np.argmax(((own - a) ** 2).sum(1))]
        for _ in range(4):  # balanced 2-means: the middle of the order is the boundary
            order = np.argsort(own @ (b - a), kind="stable")
            half = len(order) // 2
            a, b = own[order[:half]].mean(0), own[order[half:]].mean(0)
        todo += [part[order[:half]], part[order[half:]]]
    return done


def fit(sample: np.ndarray, rows: int, list_size: int = LIST_SIZE) -> Lists:
    """Centroids and their graph, from the sampled vectors of a table of ``rows`` vectors."""
    wanted = int(min(MAX_LISTS, max(1, -(-rows // list_size))))
    part = len(sample) // wanted + 1
    centroids = np.stack([sample[p].mean(0) for p in balanced_parts(sample, part)]) if len(sample) else np.zeros((0, 1))
    for _ in range(SETTLE):  # each centroid moves to the mean of the vectors nearest to it
        own = np.concatenate([distances(sample[i : i + WALK], centroids).argmin(1) for i in range(0, len(sample), WALK)] or [[]])
        sums, counts = np.zeros_like(centroids), np.bincount(own.astype(int), minlength=len(centroids))
        np.add.at(sums, own.astype(int), sample)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    d = distances(centroids, centroids)
    np.fill_diagonal(d, np.inf)
    degree = min(GRAPH_DEGREE, max(0, len(centroids) - 1))
    graph = np.argsort(d, axis=1, kind="stable")[:, :degree] if degree else np.zeros((len(centroids), 0), int)
    step = max(1, len(centroids) // 16)
    return Lists(centroids, graph, np.arange(0, len(centroids), step))


def measured_reach(lists: Lists, tests: np.ndarray, neighbours: list[np.ndarray]) -> float:
    """The ratio within which the share ``AIM`` of the tests' true neighbours is reached."""
    ratios = [0.0]
    for point, near in zip(tests, neighbours):
        own = np.sqrt(distances(point[None, :], lists.centroids)[0])
        base = base_of(np.sort(own)[None, :])[0]
        ratios += [own[held].min() / base for held in lists_of(lists, near)] if len(near) else []
    return float(np.quantile(ratios, AIM)) * (1 + 1e-9)


def walk(lists: Lists, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest centroids of each point by a best-first walk over the graph.

    Indices and distances, nearest first; places that are not filled are at infinity. A block of
    points walks in step: each opens its ``STEP`` nearest unopened centroids at a time.
    """
    rows = np.arange(len(points))[:, None]
    squares = (lists.centroids**2).sum(1)
    own = (points**2).sum(1)[:, None]
    seen = np.zeros((len(points), len(lists.centroids)), bool)

    def measure(found: np.ndarray) -> np.ndarray:
        return np.maximum(own - 2 * np.einsum("bnd,bd->bn", lists.centroids[found], points) + squares[found], 0)

    ids = np.tile(lists.entries, (len(points), 1))
    d = measure(ids)
    seen[:, lists.entries] = True
    closed = np.zeros(ids.shape, bool)
    while True:
        next_ = np.argsort(np.where(closed, np.inf, d), axis=1, kind="stable")[:, :STEP]
        live = ~closed[rows, next_] & np.isfinite(d[rows, next_])
        if not live.any() or not lists.graph.shape[1]:
            break
        closed[rows, next_] = True
        near = lists.graph[ids[rows, next_]]
        near = np.sort(np.where(live[:, :, None], near, -1).reshape(len(points), -1), axis=1)
        new = (near >= 0) & ~seen[rows, near]
        new[:, 1:] &= near[:, 1:] != near[:, :-1]
        at, column = np.nonzero(new)
        seen[at, near[at, column]] = True
        e = np.full(near.shape, np.inf)
        wide = new.any(0)
        e[:, wide] = np.where(new[:, wide], measure(near[:, wide]), np.inf)
        ids, d, closed = np.hstack((ids, near)), np.hstack((d, e)), np.hstack((closed, ~new))
        keep = np.argsort(d, axis=1, kind="stable")[:, :beam]
        ids, d, closed = ids[rows, keep], d[rows, keep], closed[rows, keep]
    keep = np.argsort(d, axis=1, kind="stable")[:, :beam]
    return ids[rows, keep], np.sqrt(d[rows, keep])


def base_of(d: np.ndarray) -> np.ndarray:
    """What ratios refer to: the mean distance of the nearest centroids, steadier than that of one."""
    return np.maximum(d[:, :REPLICAS].mean(1), 1e-12)


def lists_of(lists: Lists, points: np.ndarray) -> list[list[int]]:
    """The lists that take each vector: the nearest, and others where it lies on a boundary."""
    near, d = walk(lists, points, BEAM)
    taken = d[:, :REPLICAS] <= CLOSURE * d[:, :1]
    return [i[t].tolist() for i, t in zip(near[:, :REPLICAS], taken)]


def probes_of(lists: Lists, points: np.ndarray) -> list[list[int]]:
    """Every list within reach of each point; distances are pruned by ratio, never by number."""
    out: list[list[int]] = [[] for _ in points]
    left, beam = np.arange(len(points)), BEAM
    while len(left):
        near, d = walk(lists, points[left], beam)
        limit = np.maximum(lists.reach * base_of(d), d[:, 0])
        # The last place of a full beam beyond reach: nothing within reach was pushed out.
        ready = (d[:, -1] > limit) | (beam >= len(lists.centroids))
        for at in np.flatnonzero(ready):
            out[left[at]] = near[at][(d[at] <= limit[at]) & np.isfinite(d[at])].tolist()
        left, beam = left[~ready], beam * 2
    return out


def true_neighbours(vectors: DataFrame, tests: np.ndarray, k: int) -> list[np.ndarray]:
    """The k nearest other vectors of each test vector, by one pass over all vectors.

    A task keeps k + 1 vectors for each of the few tests, whatever the table's size.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(tests)

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tests = shared.value
        best = np.full((len(tests), k + 1), np.inf)
        points = np.zeros((len(tests), k + 1, tests.shape[1]))
        for batch in batches:
            for lo in range(0, len(batch), WALK):
                own = np.stack([np.asarray(v, float) for v in batch["vector"].iloc[lo : lo + WALK]])
                d = np.hstack((best, distances(tests, own)))
                first = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
                both = np.concatenate((points, np.broadcast_to(own, (len(tests), *own.shape))), axis=1)
                best, points = np.take_along_axis(d, first, 1), np.take_along_axis(both, first[:, :, None], 1)
        test, place = np.nonzero(np.isfinite(best))
        yield pd.DataFrame({"test": test.astype(np.int32), "d": best[test, place], "vector": list(points[test, place])})

    near = vectors.select("vector").mapInPandas(kept, "test int, d double, vector array<double>")
    first = Window.partitionBy("test").orderBy("d", "vector")
    near = near.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    out: list[list[np.ndarray]] = [[] for _ in tests]
    for row in near.orderBy("test", "n").toLocalIterator():
        vector = np.asarray(row.vector)
        if len(out[row.test]) < k and not np.array_equal(vector, tests[row.test]):
            out[row.test].append(vector)
    return [np.array(x) for x in out]


def usable(column: str) -> Column:
    v = F.col(column)
    return (
        v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0)
    )


def distinct_vectors(table: DataFrame, k: int, columns: tuple[str, str]) -> DataFrame:
    """vector and its k + 1 smallest ids, one row per distinct vector.

    The ids are cut in the map tasks already, so a common vector is no hot group.
    """
    vec_id, vector = columns
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    # -0.0 and 0.0 are the same place.
    rows = rows.filter(F.col("vec_id").isNotNull() & usable("vector")).select(
        "vec_id", F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)).alias("vector")
    )
    # One row per id: repeated rows count once, and of different vectors the least stands.
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    first = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    return kept.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.min("vec_id").alias("rep"))


def spread(rows: DataFrame, lists: Lists, choose, name: str) -> DataFrame:
    """One row per vector and list that ``choose`` names for it."""
    shared = rows.sparkSession.sparkContext.broadcast(lists)

    @F.pandas_udf("array<int>")
    def chosen(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            out: list[list[int]] = []
            for lo in range(0, len(vectors), WALK):
                out += choose(shared.value, np.stack([np.asarray(v, float) for v in vectors.iloc[lo : lo + WALK]]))
            yield pd.Series(out)

    return rows.withColumn(name, F.explode(chosen("vector")))


def search(table: DataFrame, scratch: Scratch, k: int = 10, every: int = 100, columns: tuple[str, str] = ("vec_id", "embedding"),
           list_size: int = LIST_SIZE) -> DataFrame:
    """query_id, rank, vec_id and score for every query (ids divisible by ``every``)."""
    spark = table.sparkSession
    vectors = scratch.save(distinct_vectors(table, k, columns), "vectors")
    widths = vectors.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    vectors = vectors.filter(F.size("vector") == widths.width)
    sample = vectors.orderBy(F.xxhash64("vector"), "rep").limit(SAMPLE).select("vector").toPandas()["vector"]
    sample = np.stack([np.asarray(v, float) for v in sample])
    lists = fit(sample, widths["count"], list_size)
    tests = sample[:: max(1, len(sample) // TESTS)][:TESTS]
    lists = replace(lists, reach=measured_reach(lists, tests, true_neighbours(vectors, tests, k)))

    postings = scratch.save(spread(vectors, lists, lists_of, "list"), "postings")
    # Blocks bound what a task holds; queries meet every block of their lists.
    blocks = scratch.save(postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "blocks")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    sized = postings.join(blocks, "list").select("list", block.alias("block"), "rep", "ids", "vector")
    # A group holds about GROUP blocks, so a query's answers are merged before they are shuffled.
    groups = -(-blocks.agg(F.sum("blocks")).first()[0] // GROUP)
    group = F.pmod(F.xxhash64("list", "block"), F.lit(groups))

    owners = table.select(F.col(columns[0]).cast("long").alias("id"), F.col(columns[1]).alias("v")).filter(F.col("id") % every == 0)
    owners = owners.filter(usable("v") & (F.size("v") == widths.width))
    owners = owners.select("id", F.transform("v", lambda x: x.cast("double") + F.lit(0.0)).alias("vector"))
    owners = scratch.save(owners.groupBy("id").agg(F.min("vector").alias("vector")), "owners")
    queries = owners.groupBy("vector").agg(F.min("id").alias("query"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few rows, but each walks far
    probes = spread(queries.repartition(tasks, "query"), lists, probes_of, "list")
    probes = scratch.save(probes, "probes").join(blocks, "list")
    probes = probes.select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "query", "vector")

    found = (
        probes.withColumn("group", group)
        .groupBy("group")
        .cogroup(sized.withColumn("group", group).groupBy("group"))
        .applyInPandas(lambda q, p: nearest(q, p, k + 1), "query long, rep long, score double, ids array<long>")
    )
    best = Window.partitionBy("query").orderBy("score", "rep")
    # A vector that stands in several lists is found several times, always with one score.
    found = found.groupBy("query", "rep").agg(F.first("score").alias("score"), F.first("ids").alias("ids"))
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1)
    hits = found.groupBy("query").agg(F.collect_list(F.struct("score", "ids")).alias("hits"))
    flat = F.flatten(F.transform("hits", lambda h: F.transform(h["ids"], lambda i: F.struct(h["score"].alias("score"), i.alias("vec_id")))))
    same = owners.join(queries, "vector").select("id", "query")
    answers = same.join(hits, "query").select(F.col("id").alias("query_id"), flat.alias("all"))
    ranked = F.slice(F.array_sort(F.filter("all", lambda h: h["vec_id"] != F.col("query_id"))), 1, k)
    return answers.select("query_id", F.posexplode(ranked).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score"
    )


def nearest(queries: pd.DataFrame, entries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest entries to each query in the blocks of one group that it asks for."""
    columns = ["query", "rep", "score", "ids"]
    found = []
    blocks = dict(tuple(entries.groupby(["list", "block"])))
    for key, asking in queries.groupby(["list", "block"]):
        if key not in blocks:
            continue
        own = blocks[key].sort_values("rep")
        points, reps, ids = np.stack(own["vector"].to_numpy()), own["rep"].to_numpy(), own["ids"].to_numpy()
        step = max(1, (1 << 22) // points.size)
        for lo in range(0, len(asking), step):
            part = asking.iloc[lo : lo + step]
            d = np.sqrt(((np.stack(part["vector"].to_numpy())[:, None, :] - points[None, :, :]) ** 2).sum(2))
            top = np.argsort(d, axis=1, kind="stable")[:, :k]
            who = np.repeat(part["query"].to_numpy(), top.shape[1])
            flat = top.ravel()
            found.append(pd.DataFrame({"query": who, "rep": reps[flat], "score": np.take_along_axis(d, top, 1).ravel(), "ids": ids[flat]}))
    if not found:
        return pd.DataFrame({c: pd.Series(dtype=object) for c in columns})
    merged = pd.concat(found).sort_values(["query", "score", "rep"]).drop_duplicates(["query", "rep"])
    return merged.groupby("query").head(k)[columns]


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "op3"))
