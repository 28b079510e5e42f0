"""Connected components of a graph of links."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldthread.llm.common import written

#: Links that one task contracts on its own.
TASK_LINKS = 500_000


def _contract(batches) -> Iterator[pa.RecordBatch]:
    """Links of one task as stars: every node with the least node that the task's links connect it to."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    pairs = [(u, find(u)) for u in root]
    for low in range(0, len(pairs), 50_000):
        part = [p for p in pairs[low:low + 50_000] if p[0] != p[1]]
        yield pa.RecordBatch.from_pydict({"u": pa.array([u for u, _ in part], pa.int64()), "v": pa.array([v for _, v in part], pa.int64())})


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``, long); the component is its least node.

    Tasks contract their links, ``TASK_LINKS`` at the most, to stars. If several tasks were needed, the stars are joined:
    every node tells its neighbours of the least node it knows, first the larger neighbours and then the smaller ones. Only
    minima are aggregated and joined back, no list of neighbours is gathered. Contraction and joining are repeated until
    nothing changes. Each round is written, so a lost executor costs one round at the most.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    before = None
    while True:
        tasks = math.ceil(edges.count() / TASK_LINKS)
        if tasks <= 1:
            edges = written(edges.coalesce(1).mapInArrow(_contract, "u long, v long"), "stars")
            break
        edges = written(edges.repartition(tasks).mapInArrow(_contract, "u long, v long"), "stars")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Written: it is read twice below.
        large = written(large.filter("u > v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
                 .filter("u > v").distinct())
        edges = written(small, "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
