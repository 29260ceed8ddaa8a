"""Packed token matrices as stored rows, ready to be mapped into memory by a trainer.

Each task packs the runs it has read, a block at a time: longest first, each into
the sequence with the least room that is enough, which a segment tree over room finds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import pick
from tidemark.llm.tokens import chunks, cut, encoder
from tidemark.session import new_path

#: Ids that a task packs at a time.
BLOCK_IDS = 4 << 20


class Rooms:
    """Open sequences by the room left in them: a segment tree whose leaves are amounts of room."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        at = room + self.width
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, room: int) -> tuple[int, int] | None:
        """(sequence, its room) with the least room of at least ``room``."""
        at = room + self.width
        while not self.any[at]:
            while at & 1:  # a right child: what is larger lies beyond the parent
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.width:
            at *= 2
            at += not self.any[at]
        found = at - self.width
        sequence = self.open[found].pop()
        if not self.open[found]:
            self.any[at] = 0
            at >>= 1
            while at and not (self.any[2 * at] or self.any[2 * at + 1]):
                self.any[at] = 0
                at >>= 1
        return sequence, found


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Each run's sequence and offset, and the number of sequences."""
    rooms, used = Rooms(capacity), 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        got = rooms.take(n)
        if got is None:
            got, used = (used, capacity), used + 1
        sequence[i], offset[i] = got[0], capacity - got[1]
        if got[1] > n:
            rooms.put(got[1] - n, got[0])
    return sequence, offset, used


def write_packed(
    df: DataFrame,
    tokenizer: str,
    path: str,
    capacity: int = 2048,
    closing: int = 0,
    padding: int = 0,
    dtype: str = "<u2",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write ``df``'s texts to ``path`` as packed sequences and return a reader of them.

    A row is a sequence: ``ids`` (capacity ids of ``dtype``, padded), ``position_ids``
    (the same shape; they start from 0 in every segment and run on over the padding
    from 0), ``cu_seqlens`` (0 and the ends of the segments), and ``segments`` with each
    segment's doc_id, piece, start in its text and length, in order. Texts longer than a
    sequence are cut; joining their pieces by number gives the text's ids back.

    Ids beyond ``dtype`` raise. Null and empty texts hold the closing id alone. A task
    packs blocks of BLOCK_IDS ids, so its memory is bounded (a longer text is a block
    of its own); only a block's last sequences can be wasteful. Other columns are
    ignored; an empty table gives no rows.
    """
    docs = pick(df, doc_id=id_col, text=text_col)
    segment = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.IntegerType()),
        ]
    )
    schema = T.StructType(
        [
            T.StructField("sequence_id", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("position_ids", T.BinaryType()),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType(), False)),
            T.StructField("segments", T.ArrayType(segment, False)),
        ]
    )

    def packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, closing)
        first = TaskContext.get().partitionId() << 32
        held, count = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, bounds = own.encode(part.column("text"))
                if len(ids) and int(ids.max()) > np.iinfo(dtype).max:
                    raise ValueError(f"an id of {int(ids.max())} does not fit {dtype}")
                held.append((part.column("doc_id"), ids.astype(dtype), bounds))
                count += len(ids)
                if count >= BLOCK_IDS:
                    out, n = block(held, first)
                    yield out
                    held, count, first = [], 0, first + n
        if held:
            yield block(held, first)[0]

    def block(held: list, first: int) -> tuple[pa.RecordBatch, int]:
        ids = np.concatenate([x[1] for x in held])
        keys = pa.concat_arrays([x[0] for x in held])
        shift = np.cumsum([0, *(len(x[1]) for x in held)])
        bounds = np.concatenate([[0], *(x[2][1:] + s for x, s in zip(held, shift, strict=False))])
        text, at, size = cut(bounds, capacity)
        sequence, offset, n = best_fit_decreasing(size, capacity)
        order = np.lexsort((offset, sequence))
        text, at, size, sequence, offset = (x[order] for x in (text, at, size, sequence, offset))
        place = np.repeat(sequence * capacity + offset, size)
        within = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
        matrix = np.full((n, capacity), padding, dtype)
        positions = np.zeros((n, capacity), "<u4" if capacity > 1 << 16 else "<u2")
        matrix.reshape(-1)[place + within] = ids[np.repeat(at, size) + within]
        positions.reshape(-1)[place + within] = within
        ends = offset + size
        per = np.bincount(sequence, minlength=n)
        cuts = np.concatenate([[0], np.cumsum(per)]).astype(np.int32)
        full = ends[cuts[1:] - 1]
        for i in np.flatnonzero(full < capacity):
            positions[i, full[i] :] = np.arange(capacity - full[i])
        start = at - bounds[:-1][text]
        marks = np.insert(ends, cuts[:-1], 0).astype(np.int32)
        segments = pa.StructArray.from_arrays(
            [keys.take(pa.array(text)), pa.array((start // capacity).astype(np.int32)), pa.array(start), pa.array(size.astype(np.int32))],
            names=segment.names,
        )
        arrays = [
            pa.array(first + np.arange(n)),
            pa.array([x.tobytes() for x in matrix], pa.binary()),
            pa.array([x.tobytes() for x in positions], pa.binary()),
            pa.ListArray.from_arrays(pa.array(cuts + np.arange(n + 1, dtype=np.int32)), pa.array(marks)),
            pa.ListArray.from_arrays(pa.array(cuts), segments),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=schema.names), n

    docs.mapInArrow(packed_rows, schema).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def packed_segments(df: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Write ``df``'s packed sequences below the shared folder and describe each segment as it was stored.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset); the checksum is that of
    the stored bytes, two for each id.
    """
    stored = write_packed(df, tokenizer, new_path(df.sparkSession, "packed"), capacity)
    one = F.expr(
        "transform(segments, (s, i) -> named_struct('s', s, 'offset', cast(cu_seqlens[i] as long),"
        " 'crc', crc32(substring(ids, 2 * cu_seqlens[i] + 1, 2 * s.length))))"
    )
    return stored.select("sequence_id", F.explode(one).alias("x")).select(
        "x.s.doc_id", "x.s.piece", "x.s.start", F.col("x.s.length").cast("long").alias("length"), F.col("x.crc").alias("ids_crc32"), "sequence_id", "x.offset"
    )
