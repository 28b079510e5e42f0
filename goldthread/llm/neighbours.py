"""Nearest vectors by inner product: an inverted file whose lists are scanned by an adaptive number of dimensions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldthread.llm.common import bound_batches, written

#: Bounds that do not grow with the table: lists, vectors per list from which the index is fitted, rows of a block.
MOST_LISTS, FIT_PER_LIST, BLOCK_VECTORS, BLOCK_QUERIES = 1024, 32, 4096, 2048
COVERED, COLUMN_BLOCK, EPSILON = 0.98, 16, 3.0


def usable(vectors: DataFrame) -> DataFrame:
    """Rows with a number and a vector that is neither null nor zero and whose components are all finite."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite & nonzero, F.lit(False)))


class Index:
    """Rotation, centroids and the bound on squared lengths; small enough to broadcast.

    Each vector gets one more component so that all have the same length; the largest inner product is
    then the smallest distance to the query with a zero there. The random rotation spreads the distance
    evenly over the dimensions, so that a part of them tells about the whole.
    """

    def __init__(self, sample: np.ndarray, longest: float, lists: int, seed: int = 7):
        random = np.random.default_rng(seed)
        self.longest = longest
        self.rotation = np.linalg.qr(random.standard_normal((sample.shape[1] + 1,) * 2))[0]
        points = self.turned(sample)
        self.centroids = points[random.choice(len(points), min(lists, len(points)), replace=False)]
        for _ in range(12):
            own = self.nearest(points, 1)[:, 0]
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, own, points)
            n = np.bincount(own, minlength=len(sums))
            self.centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], self.centroids)

    def turned(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        last = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.longest - (vectors ** 2).sum(1), 0))
        return np.column_stack([vectors, last]) @ self.rotation

    def probes(self, sample: np.ndarray, k: int, covered: float, asked: int = 512) -> int:
        """How many lists hold the share ``covered`` of the ``k`` nearest, measured within the fitting vectors.

        These lie thinner than the table, so their neighbours are farther off and the number is a safe one.
        """
        points, turned = self.turned(sample), self.turned(sample[:asked], query=True)
        d = (points ** 2).sum(1) - 2 * turned @ points.T
        d[np.arange(len(turned)), np.arange(len(turned))] = np.inf
        near = np.argsort(d, axis=1)[:, :k]
        from_query = (self.centroids ** 2).sum(1) - 2 * turned @ self.centroids.T
        place = np.argsort(np.argsort(from_query, axis=1), axis=1)
        own = self.nearest(points, 1)[:, 0]
        return int(np.quantile(np.take_along_axis(place, own[near], axis=1), covered)) + 1

    def nearest(self, points: np.ndarray, n: int) -> np.ndarray:
        d = (self.centroids ** 2).sum(1) - 2 * points @ self.centroids.T
        n = min(n, d.shape[1])
        return np.argpartition(d, n - 1, axis=1)[:, :n] if n < d.shape[1] else np.tile(np.arange(n), (len(d), 1))


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def scan_block(index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
               bounds: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The ``k`` best of a block for each query, by distances that are given up early.

    The rotated columns are taken block by block. After ``t`` of ``D`` columns the partial distance, scaled
    by ``D / t``, is an estimate of the whole; a candidate whose estimate exceeds the query's bound
    by more than the error of ``t`` columns explains is abandoned. Survivors get their exact inner product.
    """
    points, turned = index.turned(vectors), index.turned(queries, query=True)
    width, out = points.shape[1], []
    for low in range(0, len(queries), 64):
        q, b = turned[low:low + 64], bounds[low:low + 64]
        first = slice(0, COLUMN_BLOCK)
        part = (q[:, first] ** 2).sum(1)[:, None] + (points[:, first] ** 2).sum(1) - 2 * q[:, first] @ points[:, first].T
        done = min(COLUMN_BLOCK, width)
        limit = b * (1 + EPSILON / math.sqrt(done)) ** 2
        keep = (part * (width / done) <= limit[:, None]) & (query_ids[low:low + 64, None] != ids)
        at, to = np.nonzero(keep)
        part = part[at, to]
        while done < width and len(at):
            cols = slice(done, min(done + COLUMN_BLOCK, width))
            part = part + ((points[to, cols] - q[at, cols]) ** 2).sum(1)
            done = cols.stop
            error = (1 + EPSILON / math.sqrt(done)) ** 2 if done < width else 1 + 1e-9
            kept = part * (width / done) <= b[at] * error + 1e-9
            at, to, part = at[kept], to[kept], part[kept]
        # One row at a time is summed alike wherever it stands, so equal vectors get equal scores.
        score = (vectors[to] * queries[low + at]).sum(1)
        order = np.lexsort((ids[to], -score, at))
        at, to, score = at[order], to[order], score[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        best = place < k
        out += zip(query_ids[low + at[best]].tolist(), ids[to[best]].tolist(), score[best].tolist())
    return out


def _kth_bounds(index: Index, sample_ids: np.ndarray, sample: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int):
    """Distance of the ``k``-th nearest fitting vector: no farther vector can be among the ``k`` nearest."""
    points, turned = index.turned(sample), index.turned(queries, query=True)
    d = (turned ** 2).sum(1)[:, None] + (points ** 2).sum(1) - 2 * turned @ points.T
    d[ids[:, None] == sample_ids] = np.inf
    if d.shape[1] < k:
        return np.full(len(ids), np.inf)
    return np.partition(d, k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-9


def nearest_neighbours(vectors: DataFrame, k: int = 20, every: int = 20, covered: float = COVERED,
                       most_lists: int = MOST_LISTS) -> DataFrame:
    """The ``k`` nearest rows by inner product for every row whose ``vec_id`` is divisible by ``every``.

    The index (rotation, centroids) is fitted on at most ``most_lists * FIT_PER_LIST`` vectors, those with
    the smallest hash of their number; every vector is put into a list. A query looks into as many lists as
    hold the share ``covered`` of the neighbours among the fitting vectors. A list is cut into blocks of vectors and its queries into blocks of queries, by
    count, so a list with a third of all vectors is many tasks' work and no task holds more than two blocks.

    Returns ``query_id, rank, vec_id, score``, ties to the smaller ``vec_id``. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do those of another length than most, nor rows
    without ``vec_id``. Rows that repeat a number are candidates each on its own, and one of them asks. Fewer
    candidates than ``k`` give fewer rows; an empty table gives none; other columns are ignored.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    result = f"query_id long, rank int, vec_id {kind}, score double"
    rows = usable(vectors).withColumn("vec_id", F.col("vec_id").cast("long"))
    size = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").head()
    if size is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("embedding") == size["size"])
    squares = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    longest, total = rows.agg(F.max(squares), F.count(F.lit(1))).head()
    lists = max(1, min(most_lists, int(math.sqrt(total) / 3)))
    fit = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(lists * FIT_PER_LIST, 4 * k)).toArrow()
    sample_ids, sample = fit.column("vec_id").to_numpy(), matrix(fit.column("embedding"))
    index = Index(sample, longest, lists)
    probes = index.probes(sample, k, covered)
    shared = spark.sparkContext.broadcast((index, sample_ids, sample))

    def assign(batches):
        index = shared.value[0]
        for batch in filter(len, batches):
            own = index.nearest(index.turned(matrix(batch.column("embedding"))), 1)[:, 0]
            yield batch.append_column("list", pa.array(own, pa.int64()))

    def probe(batches):
        index, sample_ids, sample = shared.value
        for batch in filter(len, batches):
            ids, queries = batch.column("vec_id").to_numpy(zero_copy_only=False), matrix(batch.column("embedding"))
            lists = index.nearest(index.turned(queries, query=True), probes)
            yield (batch.append_column("lists", pa.array(lists.tolist(), pa.list_(pa.int64())))
                   .append_column("bound", pa.array(_kth_bounds(index, sample_ids, sample, ids, queries, k))))

    vector = vectors.schema["embedding"].dataType.simpleString()
    base = f"vec_id long, embedding {vector}"
    listed = written(rows.mapInArrow(assign, base + ", list long"), "vector-lists")
    asked = rows.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    asked = written(asked.mapInArrow(probe, base + ", lists array<long>, bound double"), "vector-queries")
    # One row per list, at most ``most_lists``.
    sizes = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK_VECTORS).alias("blocks"))
    asks = asked.select(F.explode("lists").alias("list")).groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).alias("ask_blocks"))
    plan = F.broadcast(sizes.join(asks, "list"))
    left = (listed.join(plan, "list").withColumn("block", F.expr("pmod(xxhash64(vec_id, 1), blocks)"))
            .withColumn("ask_block", F.explode(F.expr("sequence(0L, ask_blocks - 1)")))
            .select("list", "block", "ask_block", "vec_id", "embedding"))
    right = (asked.withColumn("list", F.explode("lists")).drop("lists").join(plan, "list")
             .withColumn("ask_block", F.expr("pmod(xxhash64(vec_id, 2), ask_blocks)"))
             .withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
             .select("list", "block", "ask_block", F.col("vec_id").alias("query_id"), "embedding", "bound"))

    def scan(found: pa.Table, queries: pa.Table) -> pa.Table:
        rows = []
        if found.num_rows and queries.num_rows:
            rows = scan_block(shared.value[0], found.column("vec_id").to_numpy(), matrix(found.column("embedding")),
                              queries.column("query_id").to_numpy(), matrix(queries.column("embedding")),
                              queries.column("bound").to_numpy(), k)
        return pa.Table.from_pandas(pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}), preserve_index=False)

    key = ["list", "block", "ask_block"]
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(scan, "query_id long, vec_id long, score double")
    ranked = best.withColumn("rank", F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").cast(kind).alias("vec_id"), "score")
