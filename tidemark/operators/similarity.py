"""Nearest neighbours by cosine similarity: of one entity, of many exactly, and of many through an index.

Vectors are lists of numbers of one length. Rows without a key or vector, and vectors that are zero or hold
a NULL, NaN or infinity, have no similarity to any other and are left out. Neighbours are ranked by the
similarity rounded to ``DIGITS`` places, ties by key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.rates import ratio
from tidemark.session import discard, written

DIGITS = 9
#: Query vectors that one pass compares with all rows; numbers of a product of matrices at a time.
BLOCK_QUERIES = 2048
CELLS = 1 << 20


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def similar_to(df: DataFrame, key: str, vector: str, wanted, k: int = 10) -> DataFrame:
    """The k entities with the highest cosine similarity to one entity, ties by key.

    One pass over the vectors; the one wanted vector is a scalar subquery.
    """
    probe = df.where(F.col(key) == wanted).select(vector).limit(1).scalar()
    scored = df.where(F.col(key) != wanted).withColumn("_q", probe)
    norm = F.sqrt(_dot(F.col(vector), F.col(vector))) * F.sqrt(_dot(F.col("_q"), F.col("_q")))
    scored = scored.select(key, ratio(_dot(F.col(vector), F.col("_q")), norm).alias("similarity"))
    return scored.orderBy(F.col("similarity").desc(), key).limit(k)


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(k, v): the rows that have a similarity."""
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(vector).cast("array<double>").alias("v")).where("k is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def _units(column: pa.Array) -> np.ndarray:
    """A batch's vectors as rows of length 1."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    matrix = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True) if matrix.size else matrix
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _first_of_equal(rows: DataFrame, k: int) -> DataFrame:
    """At most k + 1 rows of each distinct vector, the least keys: no further one can be among k neighbours of any row."""
    order = F.row_number().over(Window.partitionBy("v").orderBy("k"))
    return rows.withColumn("_n", order).where(F.col("_n") <= k + 1).drop("_n")


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    """(query, neighbour, similarity, rank) of the k best pairs of each query."""
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.col("similarity").desc(), "neighbour"))
    return pairs.withColumn("rank", order).where(F.col("rank") <= k)


def nearest(df: DataFrame, key: str, vector: str, queries: Column, k: int = 10) -> DataFrame:
    """(query, neighbour, similarity, rank): the k nearest other rows of every row for which ``queries`` is true.

    All rows are compared with blocks of the queries. A task keeps the k best of its rows for each query,
    and these are merged by query. Keys are whole numbers and distinct.
    """
    rows = _usable(df, key, vector)
    wanted = written(_usable(df.where(queries), key, vector), "queries")
    spark = df.sparkSession
    reduced = _first_of_equal(rows, k)
    blocks = max(1, -(-wanted.count() // BLOCK_QUERIES))
    if blocks > 1:
        reduced = written(reduced, "distinct_vectors")
    found = []
    for i in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == i).toArrow().combine_chunks()
        shared = spark.sparkContext.broadcast((block.column("k").to_numpy(), _units(block.column("v").combine_chunks())))
        found.append(reduced.mapInArrow(_best(shared, k), "query long, neighbour long, similarity double"))
        if blocks > 1:  # one block is held at a time
            found[-1] = written(found[-1], "block_neighbours")
            shared.unpersist()
    discard(wanted)
    return _ranked(reduce(DataFrame.unionAll, found), k)


def _best(shared, k: int):
    """A task's k best rows for each query of a block."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, units = shared.value
        step = max(1, CELLS // max(1, len(keys)))
        top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # place of the query, neighbour, similarity
        for batch in batches:
            for at in range(0, batch.num_rows if len(keys) else 0, step):
                part = batch.slice(at, step)
                other = part.column("k").to_numpy(zero_copy_only=False)
                score = np.round(units @ _units(part.column("v")).T, DIGITS) + 0.0
                score[keys[:, None] == other] = -np.inf
                least = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k] if len(other) > k else np.full((len(keys), 1), -2.0)
                query, place = np.nonzero((score >= least) & (score > -2))
                top = _kept([np.concatenate(c) for c in zip(top, (query, other[place], score[query, place]), strict=True)], k)
        if len(top[0]):
            yield pa.RecordBatch.from_arrays([pa.array(keys[top[0]]), pa.array(top[1]), pa.array(top[2])], names=["query", "neighbour", "similarity"])

    return best


def _kept(top: list[np.ndarray], k: int) -> tuple[np.ndarray, ...]:
    order = np.lexsort((top[1], -top[2], top[0]))
    query, other, score = (c[order] for c in top)
    first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(query)))
    keep = np.arange(len(query)) - np.repeat(first, size) < k
    return query[keep], other[keep], score[keep]


class Planes(NamedTuple):
    """Random hyperplanes of several tables, and the buckets to look into for each query and table."""

    normals: np.ndarray  # (tables, bits, dimensions)
    probes: int

    def sides(self, units: np.ndarray) -> np.ndarray:
        """Distances from the planes by (row, table, bit)."""
        return np.einsum("nd,tbd->ntb", units, self.normals)

    def buckets(self, units: np.ndarray) -> np.ndarray:
        return (self.sides(units) > 0) @ (1 << np.arange(self.normals.shape[1], dtype=np.int64))


def _flips(margins: np.ndarray, n: int) -> list[int]:
    """The n sets of bits, as masks, whose margins have the least sums, the empty one first."""
    order = np.argsort(margins)
    size, out = margins[order], [0]
    heap = [(size[0], 0, 1 << int(order[0]))] if len(size) else []
    while heap and len(out) < n:
        total, last, mask = heappop(heap)
        out.append(mask)
        if last + 1 < len(size):
            bit = 1 << int(order[last + 1])
            heappush(heap, (total + size[last + 1], last + 1, mask | bit))
            heappush(heap, (total + size[last + 1] - size[last], last + 1, mask & ~(1 << int(order[last])) | bit))
    return out


def fit_planes(
    df: DataFrame, key: str, vector: str, k: int = 10, *, tables: int = 12, rows_per_bucket: int = 64, recall: float = 0.95, sample: int = 100, seed: int = 0
) -> Planes:
    """Hyperplanes for an index of all rows, and the fewest probes that reach ``recall`` on a sample.

    The sample is about ``sample`` rows by a hash of the key, whose k nearest rows are found exactly and collected:
    sample × (k + 1) vectors. With a probe for every bucket the recall is 1, so some number of probes always does.
    """
    rows = _usable(df, key, vector)
    total = rows.count()
    bits = max(1, (total // rows_per_bucket).bit_length())
    one = rows.first()
    normals = np.random.default_rng(seed).standard_normal((tables, bits, len(one.v) if one else 1))
    if total == 0:
        return Planes(normals, 1)
    share = min(1.0, sample / total)
    chosen = F.pmod(F.xxhash64(F.lit(seed), F.col(key).cast("long")), F.lit(1 << 30)) < int(share * (1 << 30))
    pairs = nearest(df, key, vector, chosen, k)
    held = rows.withColumnsRenamed({"k": "neighbour", "v": "nv"})
    joined = pairs.join(held, "neighbour").join(rows.withColumnRenamed("k", "query"), "query").select("query", "v", "nv").toArrow().combine_chunks()
    if joined.num_rows == 0:
        return Planes(normals, 1)
    planes = Planes(normals, 1)
    margins = planes.sides(_units(joined.column("v").combine_chunks()))
    own, other = (planes.buckets(_units(joined.column(c).combine_chunks())) for c in ("v", "nv"))
    # the place of the neighbour's bucket among the query's probes, at best over the tables
    place = np.full(joined.num_rows, 1 << bits)
    for i in range(joined.num_rows):
        for t in range(tables):
            masks = _flips(np.abs(margins[i, t]), 1 << min(bits, 12))
            at = masks.index(d) if (d := int(own[i, t] ^ other[i, t])) in set(masks) else 1 << bits
            place[i] = min(place[i], at + 1)
    return Planes(normals, int(np.sort(place)[min(len(place) - 1, int(np.ceil(recall * len(place))) - 1)]))


def index_of(df: DataFrame, key: str, vector: str, planes: Planes) -> DataFrame:
    """(table, bucket, k) of every usable row in each table of the index, stored."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = len(planes.normals)
        for batch in batches:
            buckets = planes.buckets(_units(batch.column("v")))
            keys = np.repeat(batch.column("k").to_numpy(zero_copy_only=False), tables)
            table = np.tile(np.arange(tables, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(table), pa.array(buckets.reshape(-1)), pa.array(keys)], names=["table", "bucket", "k"])

    return written(_usable(df, key, vector).mapInArrow(place, "table int, bucket long, k long"), "plane_index")


def search(df: DataFrame, key: str, vector: str, queries: Column, index: DataFrame, planes: Planes, k: int = 10) -> DataFrame:
    """Like ``nearest``, among the rows that share a probed bucket with the query; none of these is left out.

    Of equal vectors only the k + 1 least keys are candidates, which bounds what one vector adds to a bucket.
    """
    rows = _first_of_equal(_usable(df, key, vector), k)
    wanted = _usable(df.where(queries), key, vector)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column("v"))
            margins, own = np.abs(planes.sides(units)), planes.buckets(units)
            out = [
                (key, t, int(own[i, t]) ^ mask)
                for i, key in enumerate(batch.column("k").to_pylist())
                for t in range(len(planes.normals))
                for mask in _flips(margins[i, t], planes.probes)
            ]
            types = (pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(zip(*out, strict=True), types, strict=True)], names=["query", "table", "bucket"])

    probes = wanted.mapInArrow(probe, "query long, table int, bucket long")
    members = index.join(rows.select("k"), "k", "left_semi")
    met = probes.join(members, ["table", "bucket"]).where("k <> query").select("query", "k").distinct()
    scored = met.join(rows, "k").join(wanted.withColumnsRenamed({"k": "query", "v": "w"}), "query")
    similarity = F.round(_dot(F.col("v"), F.col("w")) / F.sqrt(_dot(F.col("v"), F.col("v"))) / F.sqrt(_dot(F.col("w"), F.col("w"))), DIGITS)
    return _ranked(scored.select("query", F.col("k").alias("neighbour"), (similarity + 0.0).alias("similarity")), k)


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(pairs, found, recall): how many of the exact neighbours the search has found."""
    both = exact.select("query", "neighbour").join(found.select("query", "neighbour", F.lit(1).alias("_hit")), ["query", "neighbour"], "left")
    return both.agg(F.count(F.lit(1)).alias("pairs"), F.count("_hit").alias("found")).withColumn("recall", ratio(F.col("found"), F.col("pairs")))
