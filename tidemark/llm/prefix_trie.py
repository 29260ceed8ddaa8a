"""The prefix trie of conversations, and what sharing prefixes saves.

A turn's id is a fixed number of bytes in big-endian order, so a conversation is a byte
key. Long keys are cut into segments. Each task inserts the distinct segments it holds
into adaptive radix trees of bounded size and emits their nodes at whole turns; the
partial nodes of all tasks are summed by the prefix they stand for. A prefix is named by
a 128-bit sum of hashes of its turns and their places: a segment then needs just the sum of
those before it, which a running total gives however long a conversation is.
Sums over subtrees double their reach with each round, over prefixes of two or more members only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick
from tidemark.llm.radix import RadixTree
from tidemark.operators.ordered import Running, running
from tidemark.session import discard, written

#: Bytes of a turn's id, turns of a segment, and segments that one radix tree takes.
WIDTH = 16
SEGMENT_TURNS = 64
TREE_SEGMENTS = 20_000
#: Turns of a conversation, and segments of it, that one window takes; ids joined to one text.
SLICE = 4096
IDS_PER_PIECE = 1 << 16
#: A base conversation lends fewer turns than this.
MOST_BORROWED = 9

LANES = ["l0", "l1", "l2", "l3"]
_LOW = 0xFFFFFFFF


def numbered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, turn_id, size): every turn's place from 0 in its conversation, its id and its text's UTF-8 bytes.

    Turns are ordered by ``turn``, null first, equal ones by their ids. A null role or text
    is empty. Rows without a conversation id belong to none and are left out.
    """
    rows = pick(df, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn_id = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = rows.select(F.col("conv_id").cast("long"), "turn", turn_id.alias("turn_id"), F.octet_length(text).cast("long").alias("size"))
    order = [F.col("turn").asc_nulls_first(), F.col("turn_id")]
    placed = running(rows, ["conv_id"], order, {"pos": Running("sum", F.lit(1).cast("long"))}, slice_by=F.floor(F.col("turn") / SLICE))
    return placed.select("conv_id", (F.col("pos") - 1).alias("pos"), "turn_id", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversation ids, and the turns of the rebuilt conversations.

    Conversation c starts with the first h turns of conversation c - c % 5 and goes on with its own turns
    after its first h, where h is the CRC-32 of the decimal c, modulo 9.
    """
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_BORROWED
    ids = turns.select("conv_id").distinct().select("conv_id", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    heads = turns.where(F.col("pos") < MOST_BORROWED - 1).select(F.col("conv_id").alias("of"), "pos", "turn_id", "size")
    lent = ids.join(heads, (F.col("base") == F.col("of")) & (F.col("pos") < F.col("h"))).select("conv_id", "pos", "turn_id", "size")
    lengths = heads.groupBy("of").agg(F.count(F.lit(1)).alias("n"))
    shifts = ids.join(lengths, F.col("base") == F.col("of"), "left").select(
        F.col("conv_id").alias("c"), "h", (F.least("h", F.coalesce("n", F.lit(0))) - F.col("h")).alias("shift")
    )
    own = turns.join(shifts, (F.col("conv_id") == F.col("c")) & (F.col("pos") >= F.col("h")))
    own = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("pos"), "turn_id", "size")
    return ids.select("conv_id"), lent.unionByName(own)


def _lanes(a: Column, b: Column) -> list[Column]:
    """Four 32-bit numbers in longs, whose sums cannot overflow."""
    return [a.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(a, 32), b.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(b, 32)]


def _name(lanes: list[Column]) -> list[Column]:
    """Two longs of four sums modulo 2^32."""
    low = [lane.bitwiseAND(F.lit(_LOW)) for lane in lanes]
    return [F.shiftleft(low[1], 32).bitwiseOR(low[0]).alias("a"), F.shiftleft(low[3], 32).bitwiseOR(low[2]).alias("b")]


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, seg, key, sizes, h1, h2, l0..l3, a, b, depth): each conversation in runs of turns.

    l0..l3 name the prefix before the run, a and b the one after it, ``depth`` turns long.
    """
    hashed = turns.select(
        "conv_id", "pos", "turn_id", "size", F.xxhash64(F.lit(1), "pos", "turn_id").alias("h1"), F.xxhash64(F.lit(2), "pos", "turn_id").alias("h2")
    )
    one = F.struct("pos", "turn_id", "size", "h1", "h2")
    cut = hashed.groupBy("conv_id", F.expr(f"pos div {SEGMENT_TURNS}").alias("seg")).agg(
        F.sort_array(F.collect_list(one)).alias("run"), *[F.sum(lane).alias(f"s{i}") for i, lane in enumerate(_lanes(F.col("h1"), F.col("h2")))]
    )
    measures = {f"e{i}": Running("sum", F.col(f"s{i}")) for i in range(4)}
    ends = running(cut, ["conv_id"], [F.col("seg")], measures, slice_by=F.expr(f"seg div {SLICE}"))
    return ends.select(
        "conv_id",
        "seg",
        F.expr("aggregate(run.turn_id, cast('' as binary), (x, y) -> concat(x, y))").alias("key"),
        F.col("run.size").alias("sizes"),
        F.col("run.h1").alias("h1"),
        F.col("run.h2").alias("h2"),
        *[(F.col(f"e{i}") - F.col(f"s{i}")).bitwiseAND(F.lit(_LOW)).alias(lane) for i, lane in enumerate(LANES)],
        *_name([F.col(f"e{i}") for i in range(4)]),
        (F.col("seg") * SEGMENT_TURNS + F.size("run")).alias("depth"),
    )


_PARTIAL = "a long, b long, pa long, pb long, depth long, n_convs long, conv_id long, size long"


def _longs(lanes: np.ndarray) -> list[np.ndarray]:
    """Rows of four 32-bit numbers as two signed 64-bit ones."""
    return [(lanes[:, i] | lanes[:, i + 1] << np.uint64(32)).view(np.int64) for i in (0, 2)]


def _partial_nodes(turns: int, most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of radix trees over at most ``most`` segments of a task, each of up to ``turns`` turns."""
    for whole in batches:
        for first in range(0, whole.num_rows, most):
            batch = whole.slice(first, most)
            before = np.stack([batch.column(lane).to_numpy(zero_copy_only=False) for lane in LANES], axis=1).astype(np.uint64)
            sizes = batch.column("sizes")
            bounds = sizes.offsets.to_numpy() - sizes.offsets[0].as_py()
            hashes = [batch.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint64) for c in ("h1", "h2")]
            parts = np.stack([half for h in hashes for half in (h & np.uint64(_LOW), h >> np.uint64(32))], axis=1)
            total = np.concatenate([np.zeros((1, 4), np.uint64), np.cumsum(parts, axis=0)])
            tree = RadixTree()
            heads = np.ascontiguousarray(before, ">u4")
            keys, counts, least = (batch.column(c).to_pylist() for c in ("key", "n", "conv_id"))
            for row, key in enumerate(keys):
                tree.insert(heads[row].tobytes() + key, row, counts[row], least[row])
            found = [x for x in tree.aligned(WIDTH) if x[1] > 1]  # the first WIDTH bytes name the prefix before the segment
            if not found:
                continue
            row, depth, n, conv_id = (np.array(c, np.int64) for c in zip(*found, strict=True))
            turn = depth - 2  # from 0 in the segment
            at = bounds[row] + turn
            base = before[row] - total[bounds[row]]  # wraps, and is added to again
            here, there = ((base + total[at + i]) & np.uint64(_LOW) for i in (1, 0))
            place = batch.column("seg").to_numpy(zero_copy_only=False)[row] * turns + turn + 1
            size = sizes.flatten().to_numpy(zero_copy_only=False)[at]
            columns = [*_longs(here), *_longs(there), place, n, conv_id, size]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in _PARTIAL.split(", ")])


def merged_nodes(cut: DataFrame, ids: DataFrame) -> DataFrame:
    """Every prefix once: its name, its parent's, its depth, members, least member and last text's size."""
    distinct = cut.groupBy("a", "b", "depth").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), *[F.first(c).alias(c) for c in ("seg", "key", "sizes", "h1", "h2", *LANES)]
    )
    parts = distinct.mapInArrow(partial(_partial_nodes, SEGMENT_TURNS, TREE_SEGMENTS), _PARTIAL)
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    root = ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), "n_convs", "conv_id", zero.alias("size"))
    nodes = parts.groupBy("a", "b").agg(
        *[F.first(c).alias(c) for c in ("pa", "pb", "depth")], F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("size").alias("size")
    )
    return nodes.unionByName(root)


def subtree_sums(shared: DataFrame) -> DataFrame:
    """``leaves`` and ``saved`` of every row summed over its subtree; (a, b) names a row, (pa, pb) its parent.

    After k rounds a row has the sums of all below it that are fewer than 2^k steps away, and
    names its ancestor 2^k steps up. Each round is stored.
    """
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    state = shared.select("a", "b", "pa", "pb", "leaves", "saved")
    for k in range(int(deepest).bit_length()):
        below = state.where("pa is not null").groupBy(F.col("pa").alias("xa"), F.col("pb").alias("xb"))
        below = below.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        ups = state.select(F.col("a").alias("ua"), F.col("b").alias("ub"), F.col("pa").alias("na"), F.col("pb").alias("nb"))
        joined = state.join(below, (F.col("a") == F.col("xa")) & (F.col("b") == F.col("xb")), "left")
        joined = joined.join(ups, (F.col("pa") == F.col("ua")) & (F.col("pb") == F.col("ub")), "left")
        more = [(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")]
        old, state = state, written(joined.select("a", "b", F.col("na").alias("pa"), F.col("nb").alias("pb"), *more), "trie_round")
        if k:
            discard(old)
    return state


def ends(cut: DataFrame, ids: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of every prefix that is a whole conversation: the hash of the ascending ids, joined by commas.

    Ids are joined in pieces, and a prefix's pieces are hashed one after the other as they arrive in order.
    """
    last = cut.groupBy("conv_id").agg(F.max_by(F.struct("a", "b"), "seg").alias("at"))
    whole = ids.join(last, "conv_id", "left").select(*[F.coalesce(f"at.{c}", F.lit(0)).alias(c) for c in ("a", "b")], "conv_id")
    pieces = whole.groupBy("a", "b", F.expr(f"conv_id div {IDS_PER_PIECE}").alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    schema = "a long, b long, ends_sha256 string"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
                if (a, b) == now:
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    done.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield _rows(done)
        if now:
            yield _rows([(*now, state.hexdigest())])

    return pieces.repartition("a", "b").sortWithinPartitions("a", "b", "piece").mapInArrow(hashed, schema)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)], names=["a", "b", "ends_sha256"])


def prefix_trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """Every node of the trie of the conversations ``ids`` with the ``turns`` (conv_id, pos, turn_id, size).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), as the
    contract of the query says. A conversation without turns is a member of the root only. Places
    start at 0 without gaps. Without conversations there is no node, not even a root.
    """
    cut = written(segments(turns), "trie_segments")
    nodes = written(merged_nodes(cut, ids), "trie_nodes")
    children = nodes.where("pa is not null").groupBy(F.col("pa").alias("ca"), F.col("pb").alias("cb"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("alone"))
    above = nodes.join(children, (F.col("a") == F.col("ca")) & (F.col("b") == F.col("cb")), "left")
    above = above.select(*nodes.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_children", "alone")])
    # a node with one member has one leaf below it, or is one, and saves nothing
    shared = above.where((F.col("n_convs") > 1) | (F.col("depth") == 0)).select(
        "a",
        "b",
        "pa",
        "pb",
        "depth",
        (F.col("alone") + (F.col("n_children") == 0).cast("long")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    sums = subtree_sums(written(shared, "trie_shared")).select(F.col("a").alias("sa"), F.col("b").alias("sb"), "leaves", "saved")
    parents = nodes.select(F.col("a").alias("qa"), F.col("b").alias("qb"), F.col("conv_id").alias("parent_conv_id"))
    closed = ends(cut, ids).select(F.col("a").alias("ea"), F.col("b").alias("eb"), "ends_sha256")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        above.join(sums, (F.col("a") == F.col("sa")) & (F.col("b") == F.col("sb")), "left")
        .join(closed, (F.col("a") == F.col("ea")) & (F.col("b") == F.col("eb")), "left")
        .join(parents, (F.col("pa") == F.col("qa")) & (F.col("pb") == F.col("qb")), "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def conversation_trie(df: DataFrame) -> DataFrame:
    """The prefix trie of all rebuilt conversations of ``df``."""
    turns = written(numbered_turns(df), "trie_turns")
    ids, again = rebuilt(turns)
    return prefix_trie(ids, again)


#: The same in SQL: CRC-32 bit by bit, prefixes as lists, subtrees by comparing prefixes of all pairs.
ORACLE = """
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, strlen(coalesce(text, '')) AS size
    FROM conversations WHERE conv_id IS NOT NULL
), bytes AS (
    SELECT conv_id, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS b FROM (SELECT DISTINCT conv_id FROM t)
), crc AS (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
        lambda s, x: list_reduce(list_prepend(xor(s, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT) AS crc
    FROM bytes
), ids AS (
    SELECT conv_id, crc % 9 AS h, conv_id - conv_id % 5 AS base FROM crc
), lent AS (
    SELECT i.conv_id, t.pos, t.id, t.size FROM ids i JOIN t ON t.conv_id = i.base AND t.pos < i.h
), again AS (
    SELECT conv_id, 0 AS part, pos, id, size FROM lent
    UNION ALL
    SELECT t.conv_id, 1, t.pos, t.id, t.size FROM t JOIN ids i ON t.conv_id = i.conv_id AND t.pos >= i.h
), seqs AS (
    SELECT i.conv_id, coalesce(a.ids, []) AS ids, coalesce(a.sizes, []) AS sizes
    FROM ids i LEFT JOIN (SELECT conv_id, list(id ORDER BY part, pos) AS ids, list(size ORDER BY part, pos) AS sizes FROM again GROUP BY conv_id) a USING (conv_id)
), members AS (
    SELECT conv_id, d, array_to_string(ids[1:d], ',') AS node, CASE WHEN d > 0 THEN array_to_string(ids[1:d - 1], ',') END AS parent,
        d = len(ids) AS whole, CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
    FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM seqs)
), nodes AS (
    SELECT node, any_value(parent) AS parent, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (whole), '')) AS ends_sha256
    FROM members GROUP BY node, d
), counted AS (
    SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.parent = n.node AND c.depth = n.depth + 1) AS n_children FROM nodes n
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
    (SELECT count(*) FROM counted c WHERE c.n_children = 0 AND starts_with(c.node, n.node) AND c.depth >= n.depth) AS n_leaves,
    (SELECT sum((c.n_convs - 1) * c.size)::BIGINT FROM counted c WHERE starts_with(c.node, n.node) AND c.depth >= n.depth) AS saved_tokens,
    n.ends_sha256
FROM counted n LEFT JOIN nodes p ON p.node = n.parent AND p.depth = n.depth - 1
"""
