"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, staged


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """links: a, b (long). Returns node, component (its smallest node) for
    every node that has a link to another one.

    Links are first contracted inside each task to a forest of stars. Then
    rounds of large star (larger neighbours move to the smallest one) and
    small star (smaller neighbours and the node move to the smallest one)
    run until nothing changes; rounds grow with the logarithm of the nodes.
    Smallest neighbours are aggregates, so a hot node gathers nothing in one
    task, and every round is written to the shared folder."""
    edges = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = staged(in_arrow(edges, _forest, "a long, b long").distinct(), "component-links")
    before = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component"))).distinct()
        before = now
        edges = staged(_small_star(_large_star(edges)), "component-round")
    raise RuntimeError("components did not settle")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a != b").distinct()


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each local component as a star around its smallest node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(find(x), x) for x in list(root) if find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
        if len(root) > 500_000:
            yield stars()
            root.clear()
    yield stars()
