"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import ship
from .session import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (the larger ones, or all smaller ones and itself) are linked to its least neighbour instead."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    met = both.join(least, "a")
    if large:
        return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and least node of the component, of the edges of one task."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.setdefault(x, x)) != x:
            above[x] = above[up]
            x = up
        return x

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    nodes = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.array([top(x) for x in nodes], np.int64))], names=["node", "component"])


def components(edges: DataFrame, local: int = 100_000) -> DataFrame:
    """Of edges (a long, b long), each node's component: (node long, component long), the least node that it reaches.

    Nulls and loops in edges are ignored; nodes without an edge aren't listed. Edges that are at most so many are one task's, which costs no
    shuffle. More are stars, round by round: each round costs two small shuffles and is written to the shared folder; the rounds grow with the
    logarithm of the longest chain. Nothing but two sums comes to the driver.
    """
    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    ship(edges.sparkSession)
    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(edges)
    if before[0] <= local:
        return cut(edges.coalesce(1).mapInArrow(_united, "node long, component long"))
    while True:  # each round takes stars nearer to the least nodes, until none changes
        edges = cut(_star(cut(_star(edges, True)), False))
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
