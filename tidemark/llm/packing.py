"""Packing of token runs into sequences of one length, by exact complements.

Only the number of runs of each length decides a packing, and there are no more
lengths than a sequence has places. So the plan is made from that small table: a
sequence starts with the longest run left; its gap is filled exactly by a single
run, a pair or a triple looked up by the sum of their lengths, while supplies last,
else by the best-fitting run. A pattern found is used as often as supplies allow. The
runs then get their places by their rank among runs of their length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import partitions
from tidemark.llm.tokens import token_pieces
from tidemark.session import written

#: Rows that one group of the ranking holds on average.
ROWS_PER_GROUP = 100_000


class Supplies:
    """Runs left by length, and an index of which sums of two lengths can be had."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.has = self.left > 0
        self.pairs = np.zeros(2 * capacity + 1, np.int64)  # ordered pairs by sum
        for length in np.flatnonzero(self.has):
            self.pairs[length : length + capacity + 1] += self.has

    def take(self, pattern: Counter, times: int) -> None:
        for length, n in pattern.items():
            self.left[length] -= n * times
            if self.left[length] == 0:
                # sums with this length are gone; the pair of two of it is counted once
                reach = len(self.has)
                self.pairs[length : length + reach] -= 2 * self.has
                self.pairs[2 * length] += 1
                self.has[length] = False

    def _enough(self, used: Counter, *lengths: int) -> bool:
        need = Counter(lengths)
        return all(self.left[x] - used[x] >= n for x, n in need.items())

    def complement(self, gap: int, used: Counter) -> tuple[int, ...] | None:
        """One, two or three runs that fill the gap exactly, with the longest run that can be part of them."""
        if self.has[gap] and self._enough(used, gap):
            return (gap,)
        if pair := self._pair(gap, used, ()):
            return pair
        if gap < 3:
            return None
        thirds = np.arange(gap - 2, 0, -1)
        for x in thirds[self.has[thirds] & (self.pairs[gap - thirds] > 0)]:
            if pair := self._pair(gap - int(x), used, (int(x),)):
                return (int(x), *pair)
        return None

    def _pair(self, total: int, used: Counter, more: tuple[int, ...]) -> tuple[int, int] | None:
        if self.pairs[total] <= 0:
            return None
        larger = np.arange(total - 1, (total - 1) // 2, -1)
        for x in larger[self.has[larger] & self.has[total - larger]]:
            if self._enough(used, int(x), total - int(x), *more):
                return (int(x), total - int(x))
        return None

    def longest(self, limit: int, used: Counter) -> int:
        """The longest run of at most ``limit``, or 0."""
        for x in np.flatnonzero(self.has[: limit + 1])[::-1]:
            if self.left[x] > used[x]:
                return int(x)
        return 0


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, runs by length in each of them) that use up all runs."""
    supplies, found = Supplies(counts, capacity), []
    while longest := supplies.longest(capacity, Counter()):
        used, gap = Counter({longest: 1}), capacity - longest
        while gap:
            if exact := supplies.complement(gap, used):
                used.update(exact)
                break
            best = supplies.longest(gap, used)
            if not best:
                break
            used[best] += 1
            gap -= best
        times = int(min(supplies.left[x] // n for x, n in used.items()))
        supplies.take(used, times)
        found.append((times, dict(used)))
    return found


def _places(found: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """(length, first rank, runs in a sequence, first sequence, first offset), sorted: where runs go by rank."""
    ranks, rows, sequence = Counter(), [], 0
    for times, used in found:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            rows.append((length, ranks[length], n, sequence, offset))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset; ``length`` lies between 1 and ``capacity``.

    The driver gets one count for each length, ``capacity`` at most, and the tasks get
    the plan made of them, whose patterns use up a length each. Ranks are counted in
    hashed groups, so that a length which many pieces share fits. Pieces must be a stored table, as
    it is read twice. Equal rows are interchangeable.
    """
    counts = {int(r.length): r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(patterns(counts, capacity))
    groups = max(partitions(pieces), -(-sum(counts.values()) // ROWS_PER_GROUP))
    names = pieces.columns
    order = [c for c in names if c != "length"]
    keyed = pieces.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = keyed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy(*order)) - 1 + F.col("before")
    ranked = keyed.join(sizes.select("length", "part", before.alias("before")), ["length", "part"])
    ranked = ranked.select(*pieces.columns, rank.cast("long").alias("rank"))
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = np.searchsorted(places[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = np.zeros(len(length), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                a, b = firsts[x], firsts[x + 1]
                row[own] = a + np.searchsorted(places[a:b, 1], rank[own], "right") - 1
            _, first, n, sequence, offset = places[row].T
            arrays = [batch.column(c) for c in names]
            since = rank - first
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence + since // n), pa.array(offset + since % n * length)], names=schema.names
            )

    return ranked.mapInArrow(placed, schema)


def packed_documents(
    df: DataFrame, tokenizer: str, capacity: int = 2048, closing: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every text.

    Texts are tokenized once, into a stored table of pieces. Null and empty texts
    have the closing id alone; ids may be null or repeat; other columns are
    ignored; an empty table gives an empty table.
    """
    return pack(written(token_pieces(df, tokenizer, capacity, closing, id_col, text_col), "pieces"), capacity)
