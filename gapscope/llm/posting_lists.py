"""Approximate nearest neighbours: balanced posting lists under an in-memory graph of centroids.

Centroids come from a bounded sample, cut in halves again and again along
the direction between two means, so every list gets a like share. Every
vector of the table is indexed: in the list of its nearest centroid and, if
it lies near a boundary, in further lists whose centroids are nearly as near
and not hidden behind a chosen one. The centroids (at most ``MOST_LISTS``)
and their neighbour graph are broadcast. A query walks the graph to its
nearest centroids and reads the lists whose distance is within a ratio of
the nearest one's. Centroids that are equal up to rounding are one, so equal
vectors share their lists and the queries that read them. Queries that find
fewer than ``k`` rows read more lists until they have ``k`` or have read all.

A list that many vectors share is dealt to several blocks, and so are the
queries that read one list; a task compares one block of queries with one
block of vectors. Blocks hand on their best ``k`` only. Shortlisted pairs are
scored again in double precision on the original vectors, in a fixed order
of operations, so equal vectors tie exactly.

Defined results: vectors that are null, all zero, or hold null or non-finite
components take no part, nor do rows without an id, nor vectors whose length
is not the table's most frequent one; repeated ids count once (the least of
their vectors); a query has fewer than ``k`` rows only if the table has fewer
other vectors, and none if it has no other; an empty table gives
an empty table. Other columns are not used.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscope.llm.common import read, stored

SAMPLE_ROWS = 20_000
#: Vectors a list holds on average, before replication; the most lists.
LIST_SIZE, MOST_LISTS = 256, 4096
#: A vector goes to lists up to this ratio of its nearest centroid's distance, and to so many at most.
REPLICA_RATIO, MOST_REPLICAS = 1.05, 3
#: A query reads lists up to this ratio of its nearest centroid's distance, among so many nearest centroids.
PROBE_RATIO, MOST_PROBES = 1.22, 256
#: A query short of rows reads so many nearest lists, then so many times as many, and so on.
MORE_LISTS, MORE_TIMES = 16, 4
#: Distances below this are rounding noise (a distance is the root of a difference with an error of 1e-16 or more).
NOISE = 1e-6
GRAPH_DEGREE, BEAM = 24, 256
VECTOR_BLOCK, QUERY_BLOCK = 2048, 512


@dataclass
class Centroids:
    """Unit centroids, and for each its near ones (``graph[i]``); ``entry`` are the walk's first nodes."""

    points: np.ndarray
    graph: list[np.ndarray]
    entry: np.ndarray

    def nearest(self, query: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances), nearest first, by a best-first walk of the graph with a beam."""
        beam = max(BEAM, count)
        seen = set(self.entry.tolist())
        first = distances(query, self.points[self.entry])
        open_ = [(d, int(i)) for d, i in zip(first, self.entry)]
        heapq.heapify(open_)
        best = [(-d, i) for d, i in open_]
        heapq.heapify(best)
        while open_:
            d, i = heapq.heappop(open_)
            if len(best) >= beam and d > -best[0][0]:
                break
            fresh = [j for j in self.graph[i].tolist() if j not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for e, j in zip(distances(query, self.points[fresh]), fresh):
                if len(best) < beam or e < -best[0][0]:
                    heapq.heappush(open_, (e, j))
                    heapq.heappush(best, (-e, j))
                    if len(best) > beam:
                        heapq.heappop(best)
        found = sorted((-d, i) for d, i in best)[:count]
        return np.array([i for _, i in found]), np.array([d for d, _ in found])

    def probes(self, query: np.ndarray, least: int = 1) -> np.ndarray:
        """The lists a query reads, at least the ``least`` nearest."""
        if least >= len(self.points):
            return np.arange(len(self.points))
        ids, far = self.nearest(query, max(MOST_PROBES, least))
        return ids[(far <= PROBE_RATIO * max(far[0], NOISE)) | (np.arange(len(ids)) < least)]

    def replicas(self, vectors: np.ndarray) -> list[list[int]]:
        """The lists each unit vector goes to: the nearest, and boundary lists no chosen centroid hides."""
        far = np.sqrt(np.maximum(2 - 2 * vectors @ self.points.T, 0))
        near = np.argsort(far, axis=1, kind="stable")[:, : 4 * MOST_REPLICAS]
        out = []
        for row, order in zip(far, near):
            chosen: list[int] = []
            for j in order:
                if len(chosen) == MOST_REPLICAS or row[j] > REPLICA_RATIO * max(row[order[0]], NOISE):
                    break
                if not chosen or np.linalg.norm(self.points[chosen] - self.points[j], axis=1).min() >= row[j]:
                    chosen.append(int(j))
            out.append(chosen)
        return out


def distances(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * points @ query, 0))


def halves(vectors: np.ndarray, lists: int, seed: int = 0) -> np.ndarray:
    """``lists`` unit centroids of equal shares of the sample."""
    rng = np.random.default_rng(seed)
    todo, done = [(np.arange(len(vectors)), min(lists, len(vectors)))], []
    while todo:
        rows, parts = todo.pop()
        if parts <= 1:
            mean = vectors[rows].mean(0)
            length = np.linalg.norm(mean)
            done.append(mean / length if length > 1e-9 else vectors[rows[0]])
            continue
        own = vectors[rows]
        a, b = own[rng.choice(len(own), 2, replace=False)]
        left = parts // 2
        cut = len(rows) * left // parts
        for _ in range(5):
            order = np.argsort(own @ (b - a), kind="stable")
            a, b = own[order[:cut]].mean(0), own[order[cut:]].mean(0)
        todo += [(rows[order[:cut]], left), (rows[order[cut:]], parts - left)]
    return np.array(done)


def apart(points: np.ndarray) -> np.ndarray:
    """``points`` without those that equal an earlier one up to ``NOISE``."""
    kept = np.ones(len(points), bool)
    for i in range(len(points)):
        if kept[i]:
            kept[i + 1:] &= np.abs(points[i + 1:] - points[i]).max(1, initial=0) > NOISE
    return points[kept]


def centroid_graph(points: np.ndarray) -> Centroids:
    """Each centroid with its ``GRAPH_DEGREE`` nearest, links both ways, and a ring so that all can be reached."""
    points = apart(points)
    n = len(points)
    links: list[set[int]] = [set() for _ in range(n)]
    for at in range(0, n, 1024):
        near = np.argsort(-(points[at: at + 1024] @ points.T), axis=1, kind="stable")[:, : GRAPH_DEGREE + 1]
        for i, row in enumerate(near, at):
            for j in row.tolist():
                if j != i:
                    links[i].add(j)
                    links[j].add(i)
    for i in range(n):
        if n > 1:
            links[i].add((i + 1) % n)
    spread = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(int))
    return Centroids(points, [np.array(sorted(x), np.int64) for x in links], spread)


# --- index ----------------------------------------------------------------------


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector, length): one row per id whose vector takes part."""
    v = F.col("vector")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    rows = (
        vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where("vec_id is not null and vector is not null")
        .where(finite & (F.size(v) > 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))
        .withColumn("length", length).where("length > 0 and length < double('infinity')")
    )
    return rows


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.list_(pa.float64()))
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def units(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def fit(rows: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS) -> Centroids:
    """Centroids from at most ``sample_rows`` vectors, chosen by the id's hash."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("vector").toArrow()
    lists = max(1, min(MOST_LISTS, n // LIST_SIZE))
    return centroid_graph(halves(units(matrix(sample.column("vector"))), lists))


def with_lists(rows: DataFrame, centroids, which: str, least: int = 1) -> DataFrame:
    """``rows`` once for each list they go to (``replicas``) or read (``probes``, at least ``least`` lists)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                unit = units(matrix(part.column(1)))
                lists = centroids.value.replicas(unit) if which == "replicas" else [centroids.value.probes(u, least) for u in unit]
                taken = part.take(pa.array(np.repeat(np.arange(len(unit)), [len(x) for x in lists])))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(np.concatenate(lists).astype(np.int32), pa.int32())], names=[*taken.schema.names, "list"])

    return rows.mapInArrow(run, f"vec_id long, vector {rows.schema['vector'].dataType.simpleString()}, length double, list int")


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(list, <name>): how many blocks of about ``size`` rows each list has; at most ``MOST_LISTS`` rows."""
    return rows.groupBy("list").agg(F.ceil(F.count("*") / size).cast("int").alias(name))


def compare(k: int):
    """Best ``k`` of a block of vectors for each of a block of queries."""
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if queries.num_rows and vectors.num_rows:
            q, v = matrix(queries.column("vector")), matrix(vectors.column("vector"))
            ql, vl = queries.column("length").to_numpy(), vectors.column("length").to_numpy()
            ids = vectors.column("vec_id").to_numpy()
            rough = (q / ql[:, None]) @ (v / vl[:, None]).T
            for i, own in enumerate(queries.column("vec_id").to_pylist()):
                rough[i, ids == own] = -9.0
                least = np.partition(rough[i], -k)[-k] if len(ids) > k else -8.0
                near = np.flatnonzero((rough[i] >= least - 1e-9) & (rough[i] > -8.0))
                exact = (v[near] * q[i]).sum(1) / (vl[near] * ql[i])
                for j in np.lexsort((ids[near], -exact))[:k]:
                    out.append((own, int(ids[near[j]]), float(exact[j])))
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "score": pa.array([r[2] for r in out], pa.float64())})

    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` picks, its ``k`` nearest other rows by cosine."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = stored(usable(vectors, key, vector), "ann-vectors")
    usual = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if usual is None:
        return empty
    rows = rows.where(F.size("vector") == usual["d"])
    centroids = spark.sparkContext.broadcast(fit(rows, usual["count"]))
    listed = stored(with_lists(rows, centroids, "replicas"), "ann-lists")
    queries, n_lists, least = rows.where(is_query), len(centroids.value.points), 1
    best = stored(best_of(listed, stored(with_lists(queries, centroids, "probes"), "ann-probes"), k), "ann-best")
    while least < n_lists:
        least = min(n_lists, least * MORE_TIMES if least > 1 else MORE_LISTS)
        full = best.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
        short = stored(queries.join(full, "vec_id", "left_anti").select(*rows.columns), "ann-short")
        if short.isEmpty():
            break
        more = best_of(listed, stored(with_lists(short, centroids, "probes", least), "ann-probes"), k)
        done = best.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").select(*best.columns)
        best = stored(done.unionByName(more), "ann-best")
    return best


def best_of(listed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` of each query among the vectors of the lists it reads."""
    # a cell is a block of a list's vectors and a block of the queries that read the list
    sizes = stored(blocks(listed, VECTOR_BLOCK, "vector_blocks").join(blocks(asked, QUERY_BLOCK, "query_blocks"), "list"), "ann-blocks")
    each = lambda own, other: (
        F.expr(f"pmod(xxhash64(vec_id), {own})").cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    vb, qb = each("vector_blocks", "query_blocks")
    dealt = listed.join(sizes, "list").select("list", vb.alias("vb"), qb.alias("qb"), "vec_id", "vector", "length")
    qb, vb = each("query_blocks", "vector_blocks")
    reading = asked.join(sizes, "list").select("list", vb.alias("vb"), qb.alias("qb"), "vec_id", "vector", "length")
    cell = ("list", "vb", "qb")
    found = reading.groupBy(*cell).cogroup(dealt.groupBy(*cell)).applyInArrow(compare(k), "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # a vector in several lists has the same score in each
    once = found.distinct().withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return once.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op9_posting_lists": op9_posting_lists}
