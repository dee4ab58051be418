"""Approximate nearest neighbours by balanced posting lists (after SPANN, Chen et al., 2021).

Vectors are compared by cosine, so lists are built on unit vectors. Centroids are fitted on a bounded sample with a
penalty on large clusters; a graph over them, small enough for every task's memory, finds the nearest ones by a beam
search. A vector is posted to the lists whose centroid is nearly as near as its nearest one, so vectors at a border are
found from both sides; a list whose centroid is nearer to one already taken than to the vector adds no other side. A query reads the lists whose centroid distance is within a ratio of its nearest one. How wide
the ratio and the beam must be depends on the vectors: they are set from a few queries whose true neighbours are found by
comparing them with every vector. Rows of lists are compared in blocks, in double precision.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockflow.llm.common import stored

LIST_ROWS = 128
MAX_LISTS = 16_384  # bounds the centroids that every task holds
SAMPLE_PER_LIST = 24
SAMPLE_BYTES = 64 << 20  # bounds the sample that the driver fits on
BLOCK_ROWS = 8_192
DEGREE = 24
POST_RATIO, MOST_POSTS = 1.15, 6
LEAST_LISTS = 1
CLOSE = 1e-9  # scores of block products this near may tie when summed in fixed order
PAIRS = 65_536
TRIAL_QUERIES = 96
TRIAL_SHARE = 0.99  # of the true neighbours of the trial queries must be in reach of the ratio, and of the beam


@dataclass
class Centroids:
    """Unit-space centroids and a graph over them; searched by a beam, many vectors at a time."""

    points: np.ndarray
    graph: np.ndarray
    entries: np.ndarray

    def search(self, vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances of the ``beam`` nearest centroids found, nearest first."""
        n, k = len(vectors), len(self.points)
        beam = min(beam, k)
        if k <= beam:  # every centroid is asked for
            distance = _squared(vectors, self.points)
            ids = np.argsort(distance, axis=1, kind="stable")[:, :beam]
            return ids, np.take_along_axis(distance, ids, 1)
        start = _squared(vectors, self.points[self.entries])
        first = np.argsort(start, axis=1, kind="stable")[:, :beam]
        ids, distance = self.entries[first], np.take_along_axis(start, first, 1)
        if ids.shape[1] < beam:
            more = beam - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, more)), constant_values=-1)
            distance = np.pad(distance, ((0, 0), (0, more)), constant_values=np.inf)
        done = np.isinf(distance)
        live = np.arange(n)
        while len(live):
            nearest = np.where(done[live], np.inf, distance[live]).argmin(axis=1)
            open_ = ~done[live, nearest]
            live, nearest = live[open_], nearest[open_]
            if not len(live):
                break
            done[live, nearest] = True
            around = self.graph[ids[live, nearest]]
            near = _each_squared(vectors[live], self.points[around])
            all_ids = np.concatenate([ids[live], around], axis=1)
            all_distance = np.concatenate([distance[live], near], axis=1)
            all_done = np.concatenate([done[live], np.zeros_like(around, dtype=bool)], axis=1)
            order = np.lexsort((~all_done, all_ids), axis=1)  # a centroid met before keeps its mark
            sorted_ids = np.take_along_axis(all_ids, order, 1)
            again = np.zeros_like(order, dtype=bool)
            again[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
            sorted_distance = np.where(again, np.inf, np.take_along_axis(all_distance, order, 1))
            best = np.argsort(sorted_distance, axis=1, kind="stable")[:, :beam]
            ids[live] = np.take_along_axis(sorted_ids, best, 1)
            distance[live] = np.take_along_axis(sorted_distance, best, 1)
            done[live] = np.take_along_axis(np.take_along_axis(all_done, order, 1), best, 1) | np.isinf(distance[live])
        return ids, distance


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def _each_squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(2) - 2 * np.einsum("nd,nrd->nr", a, b), 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    return (vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))).astype(np.float32)


def fit(sample: np.ndarray, lists: int, rounds: int = 10, seed: int = 42) -> Centroids:
    """Balanced k-means on unit vectors: a cluster's share of the sample adds to the distance of joining it."""
    random = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    points = sample[random.choice(len(sample), lists, replace=False)].copy()
    load = np.full(lists, len(sample) / lists)
    for step in range(rounds):
        nearest, cost = np.empty(len(sample), dtype=np.int64), 0.0
        for at in range(0, len(sample), 4096):
            distance = _squared(sample[at : at + 4096], points)
            penalty = 0.1 * distance.min(axis=1).mean() * np.maximum(load / load.mean() - 1, 0)
            nearest[at : at + 4096] = (distance + penalty).argmin(axis=1)
        load = np.bincount(nearest, minlength=lists).astype(float)
        order = np.argsort(nearest, kind="stable")
        full = np.flatnonzero(load)
        starts = np.searchsorted(nearest[order], full)
        points[full] = np.add.reduceat(sample[order], starts, axis=0) / load[full, None]
        if step < rounds - 1 and (empty := np.flatnonzero(load == 0)).size:
            crowded = np.argsort(-load)[: len(empty)]  # an empty cluster starts anew inside a crowded one
            for e, c in zip(empty, crowded, strict=False):
                points[e] = sample[random.choice(np.flatnonzero(nearest == c))]
    # Means of many directions are short and so lie near each other; as directions they are as far apart as the vectors.
    norms = np.sqrt((points * points).sum(axis=1, keepdims=True))
    return graph_of((points / np.where(norms > 0, norms, 1)).astype(np.float32), random)


def graph_of(points: np.ndarray, random: np.random.Generator) -> Centroids:
    k = len(points)
    degree = min(DEGREE, k - 1)
    near = np.empty((k, degree), dtype=np.int64)
    for at in range(0, k, 1024):
        distance = _squared(points[at : at + 1024], points)
        distance[np.arange(len(distance)), at + np.arange(len(distance))] = np.inf
        if degree:
            near[at : at + 1024] = np.argsort(distance, axis=1, kind="stable")[:, :degree]
    far = random.integers(0, k, size=(k, 6))  # long edges keep the graph in one piece
    entries = np.sort(random.choice(k, min(k, 64), replace=False))
    return Centroids(points, np.concatenate([near, far], axis=1), entries)


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: not null or zero, all components finite.

    Cosine needs vectors of one length; those of the most frequent length (the smaller one, if two are) take part.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector).alias("embedding"))
    rows = rows.where(
        "vec_id IS NOT NULL AND embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) "
        "OR abs(x) = double('infinity')) AND exists(embedding, x -> x != 0)"
    )
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (lengths["n"] if lengths else 0))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(gid, ids, embedding): every different vector once, with the ``k + 1`` smallest ids that have it.

    All copies of a vector are as near to any query, so no larger id of them can be among its k nearest.
    """
    order = Window.partitionBy("embedding").orderBy("vec_id")
    # Repeats go first, so that the limit of each group holds before the shuffle however often a row is repeated.
    first = rows.distinct().withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    grouped = first.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    return grouped.select(F.col("ids")[0].alias("gid"), "ids", "embedding")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def post_lists(x: np.ndarray, centroids: Centroids, ratio: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists near each vector, nearest first, and which of them it is posted to."""
    ids, squared = centroids.search(x, 2 * most)
    near = np.sqrt(squared) <= ratio * np.sqrt(squared[:, :1])
    near[:, 0] = True
    take = np.zeros_like(near)
    for at in range(0, len(x), 1024):
        rows = slice(at, at + 1024)
        around = centroids.points[ids[rows]]
        for j in range(ids.shape[1]):
            between = _each_squared(around[:, j], around[:, :j])
            beside = (take[rows, :j] & (between < squared[rows, j, None])).any(axis=1)
            take[rows, j] = near[rows, j] & ~beside & (take[rows, :j].sum(axis=1) < most)
    return ids, take


def posted(vectors: DataFrame, centroids: Centroids, ratio: float, most: int) -> DataFrame:
    """Rows of vectors once for each list they are posted to, with ``list``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _repeat(batch, *post_lists(unit(_matrix(batch.column("embedding"))), centroids, ratio, most))

    return vectors.mapInArrow(run, "gid bigint, ids array<bigint>, embedding array<double>, list bigint")


def reach(index: DataFrame, queries: DataFrame, centroids: Centroids, k: int) -> tuple[float, int]:
    """The ratio and beam that put the true neighbours of a few queries in reach.

    The queries are the first by hash, at most ``TRIAL_QUERIES``; every task compares them with its vectors and keeps
    their k nearest, of which a second step takes the nearest of all.
    """
    rows = queries.orderBy(F.xxhash64("gid", F.lit("trial")), "gid").limit(TRIAL_QUERIES).select("gid", "embedding").collect()
    if not rows:
        return 1.0, 1
    own, asked = np.array([r[0] for r in rows]), unit(np.array([r[1] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = asked @ unit(_matrix(batch.column("embedding"))).T
            gid = batch.column("gid").to_numpy()
            score[own[:, None] == gid[None, :]] = -2
            best = np.argsort(-score, axis=1)[:, :k]
            at = np.repeat(np.arange(len(own)), best.shape[1])
            found = batch.column("embedding").take(pa.array(best.ravel()))
            near = pa.array(score[at, best.ravel()].astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(at), near, pa.array(gid[best.ravel()]), found], ["at", "score", "gid", "embedding"])

    near = index.mapInArrow(run, "at bigint, score double, gid bigint, embedding array<double>").where("score > -2")
    order = Window.partitionBy("at").orderBy(F.desc("score"), "gid")
    true = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("at", "embedding").collect()
    if not true:
        return 1.0, 1
    at = np.array([r[0] for r in true])
    lists, take = post_lists(unit(np.array([r[1] for r in true])), centroids, POST_RATIO, MOST_POSTS)
    distance = np.sqrt(_squared(asked, centroids.points))
    rank = np.argsort(np.argsort(distance, axis=1, kind="stable"), axis=1, kind="stable")
    needed = np.where(take, rank[at[:, None], lists], len(centroids.points)).argmin(axis=1)
    best = lists[np.arange(len(at)), needed]
    ratio = distance[at, best] / np.maximum(distance.min(axis=1)[at], 1e-12)
    wide = int(np.quantile(rank[at, best], TRIAL_SHARE, method="higher")) + 1
    return float(np.quantile(ratio, TRIAL_SHARE, method="higher")), wide


def probed(vectors: DataFrame, centroids: Centroids, ratio: float, beam: int, least: int) -> DataFrame:
    """Query vectors once for each list they read: within the ratio of the nearest centroid, ``least`` lists at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, squared = centroids.search(unit(_matrix(batch.column("embedding"))), beam)
                take = np.sqrt(squared) <= ratio * np.sqrt(squared[:, :1])
                take[:, : max(least, 1)] = True
                yield _repeat(batch, ids, take & np.isfinite(squared))

    return vectors.mapInArrow(run, "gid bigint, ids array<bigint>, embedding array<double>, list bigint")


def _repeat(batch: pa.RecordBatch, ids: np.ndarray, take: np.ndarray) -> pa.RecordBatch:
    row, at = np.nonzero(take)
    rows = batch.take(pa.array(row))
    return pa.RecordBatch.from_arrays([*rows.columns, pa.array(ids[row, at])], [*rows.schema.names, "list"])


def _compare(k: int):
    schema = pa.schema([("query", pa.int64()), ("gid", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def run(lists: pa.Table, queries: pa.Table) -> pa.Table:
        if not lists.num_rows or not queries.num_rows:
            return schema.empty_table()
        lists, queries = lists.combine_chunks(), queries.combine_chunks()
        a, b = (_matrix(t.column("embedding").combine_chunks()) for t in (queries, lists))
        na, nb = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (a, b))
        gid = lists.column("gid").to_numpy()
        rows, found, scores = [], [], []
        for at in range(0, len(a), 512):
            score = a[at : at + 512] @ b.T / na[at : at + 512, None] / nb[None, :]
            keep = min(k + 1, len(b))
            last = -np.partition(-score, keep - 1, axis=1)[:, keep - 1 : keep]
            row, col = np.nonzero(score >= last - CLOSE)  # all that may tie; products are ordered again by a sum of fixed order
            sums = [np.einsum("ij,ij->i", a[at + row[i : i + PAIRS]], b[col[i : i + PAIRS]]) for i in range(0, len(row), PAIRS)]
            value = np.concatenate(sums) / (na[at + row] * nb[col])
            order = np.lexsort((gid[col], -value, row))
            row, col, value = row[order], col[order], value[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) <= k
            rows.append(at + row[best])
            found.append(col[best])
            scores.append(value[best])
        row, col, exact = np.concatenate(rows), np.concatenate(found), np.concatenate(scores)
        row, col = pa.array(row), pa.array(col)
        columns = [queries.column("gid").take(row), pa.array(gid).take(col), lists.column("ids").take(col), pa.array(exact)]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=schema)

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector: str = "embedding",
    list_rows: int = LIST_ROWS,
    least_lists: int = LEAST_LISTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest found of every query row: query_id, rank (from 1), vec_id, score (cosine in double precision).

    ``is_query`` is a condition on vec_id. Nearest first, ties to the smaller vec_id; a query is not its own candidate,
    its copies are. Vectors that are null, zero, of another length than most, or hold a null or non-finite component,
    and rows without vec_id, take no part. Repeated rows (same id and vector) count once; an id with several vectors is a
    candidate with each, and as a query has the nearest of all. An empty table gives no rows. Other columns are not read.

    The fit sees ``SAMPLE_PER_LIST`` vectors a list, at most ``SAMPLE_BYTES``; every vector is indexed, and the number of
    lists a query reads is what ``reach`` finds the vectors to need.
    """
    rows = stored(usable(vectors, id_column, vector), "vectors")
    index = distinct_vectors(rows, k).select("gid", "ids", F.col("embedding").cast("array<double>").alias("embedding"))
    index = stored(index, "index")
    n, size = index.agg(F.count("*"), F.max(F.size("embedding"))).first()
    lists = max(1, min(MAX_LISTS, ceil(n / list_rows)))
    sample_rows = max(lists, min(n, SAMPLE_PER_LIST * lists, SAMPLE_BYTES // (4 * (size or 1))))
    sample = index.orderBy(F.xxhash64("gid"), "gid").limit(sample_rows).select(F.col("embedding").cast("array<float>"))
    points = unit(np.array([r[0] for r in sample.collect()], dtype=np.float32).reshape(-1, size or 1))
    centroids = fit(points, lists)
    posts = stored(posted(index, centroids, POST_RATIO, MOST_POSTS), "postings")
    asked = rows.where(is_query).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    queries = index.join(asked.select("embedding").distinct(), "embedding", "left_semi").select(*index.columns)
    queries = stored(queries, "queries")
    ratio, beam = reach(index, queries, centroids, k)
    reads = stored(probed(queries, centroids, ratio, max(beam + beam // 8, least_lists), least_lists), "reads")
    blocks = posts.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    parts = reads.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("parts"))
    sizes = blocks.join(parts, "list")  # a row per list
    left = posts.join(sizes, "list").select(
        "list",
        F.expr("pmod(xxhash64(gid), blocks)").cast("int").alias("block"),
        F.explode(F.expr("sequence(0, parts - 1)")).alias("part"),
        "gid",
        "ids",
        "embedding",
    )
    right = reads.join(sizes, "list").select(
        "list",
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.expr("pmod(xxhash64(gid), parts)").cast("int").alias("part"),
        "gid",
        "embedding",
    )
    keys = ["list", "block", "part"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _compare(k), "query bigint, gid bigint, ids array<bigint>, score double"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "gid")
    found = (
        pairs.groupBy("query", "gid")
        .agg(F.max(F.struct("score", "ids")).alias("s"))
        .select("query", "gid", "s.score", "s.ids")
        .withColumn("at", F.row_number().over(best))
        .where(F.col("at") <= k + 1)
        .drop("at")
    )
    named = asked.join(index.select("gid", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), "gid").distinct()
    candidates = named.join(found.withColumnRenamed("gid", "other"), F.col("gid") == F.col("query")).select(
        "query_id", "score", F.explode("ids").alias("vec_id")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
