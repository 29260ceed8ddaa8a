"""Connected components of an edge table, by alternating stars over edges that tasks have contracted."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (the larger ones, or the others) joined to its smallest neighbour instead."""
    if large:
        near = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = near.join(least, "u")
    if large:
        return moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    kept = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return kept.where("a <> b").distinct()


def stars(nodes: list, pairs: list[tuple[int, int]]) -> list[tuple]:
    """(node, smallest node connected with it) for the nodes that pairs of numbers connect, but for the smallest themselves."""
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in pairs:
        x, y = root(x), root(y)
        if x != y:
            low, high = (x, y) if nodes[x] < nodes[y] else (y, x)
            parent[high] = low
    return [(nodes[x], nodes[root(x)]) for x in range(len(nodes)) if root(x) != x]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars: no more edges than nodes, and all that they connect."""
    numbers: dict = {}
    pairs: list[tuple[int, int]] = []
    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            pairs.append((numbers.setdefault(a, len(numbers)), numbers.setdefault(b, len(numbers))))
        if len(pairs) > 1_000_000:
            pairs = [(numbers[a], numbers[b]) for a, b in stars(list(numbers), pairs)]
    found = stars(list(numbers), pairs)
    for k in range(0, len(found), 100_000):
        columns = zip(*found[k : k + 100_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=["a", "b"])


def _contract(edges: DataFrame) -> DataFrame:
    return edges.mapInArrow(_contracted, edges.schema)


def _has_chains(edges: DataFrame) -> bool:
    """Whether some node has two edges, or an edge and others that end in it."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    return not ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR out = 1 AND into = 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node that is connected with it.

    Every round stores its edges; rounds grow with the logarithm of the longest chain that is left when
    each task has contracted its edges. Loops and repeated edges change nothing; nodes are not null.
    """
    current = written(_contract(edges.where("a <> b").toDF("a", "b")).distinct(), "edges")
    while _has_chains(current):
        before, current = current, written(_contract(_star(_star(current, True), False)).distinct(), "edges")
        discard(before)
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
