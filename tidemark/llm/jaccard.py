"""Groups of documents whose word n-gram sets are similar, exactly.

Two sets with a Jaccard similarity of t or more share a gram among the first few of
each in any one order of all grams. Here grams with small hashes (the zone) come
first, rarer ones before more frequent ones; so most documents have only grams of
their own there, and drop out. Sets that share many grams of their beginnings are
clustered; of others that share one by chance, a pair counts only if the parities of
their grams, a bit for each of some bins, leave room for a link. Within a cluster
every set is held against the others of its size by those parities, sixty-four bins
at a time, and counted gram by gram only with sets that may be linked and are not connected yet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import packed, partitions, pick
from tidemark.llm.components import components, stars
from tidemark.llm.hashing import HASHED_BYTES, mixed, word_hashes
from tidemark.llm.tokens import chunks
from tidemark.session import written

#: Grams that one group of the counting holds, and grams of a cluster that one task joins.
GRAMS_COUNTED, GRAMS_JOINED = 4_000_000, 2_000_000
#: Sets that share a gram, from which on one that has many of its grams from such crowds is clustered with them unseen.
CROWD = 32
#: Documents of a chunk; their numbers fit 16 bits.
CHUNK_ROWS = 30_000
_A = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Likeness:
    """Sets are linked when ``of`` * intersection >= ``least`` * union."""

    least: int
    of: int = 100

    def prefix(self, n):
        """Grams at a set's beginning one of which any linked set shares in its own."""
        return n - -(-self.least * n // self.of) + 1

    def overlap(self, n, m):
        """The smallest intersection of linked sets of sizes n and m."""
        return -(-self.least * (n + m) // (self.least + self.of))

    def difference(self, n, m):
        """The most grams that one of two linked sets of sizes n and m has and the other lacks, both ways."""
        return n + m - 2 * self.overlap(n, m)


def gram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Each text's distinct n-grams as sorted 64-bit hashes; fewer words than n are one gram, none are none."""
    words, bounds = word_hashes(texts)
    gram = np.full(max(len(words) - n + 1, 0), np.uint64(n), np.uint64)
    for k in range(n):
        gram = mixed(gram * _A + words[k : len(words) - n + 1 + k])
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            own = np.sort(gram[a : b - n + 1])
            if len(own) > 1:
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:
            own = np.full(min(b - a, 1), np.uint64(b - a), np.uint64)
            for k in range(a, b):
                own = mixed(own * _A + words[k])
        out.append(own)
    return out


def signature(grams: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    return hashlib.md5(grams.astype("<u8").tobytes()).digest()


def bins(n: int, each: int = 2) -> int:
    """The bins of a set's parities: a power of 2, at least 64 and ``each`` for each of its grams."""
    return 1 << max(6, (each * n - 1).bit_length())


def _binned(sets: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(sets), width // 64), np.uint64)
    place = np.concatenate(sets) & np.uint64(width - 1)
    row = np.repeat(np.arange(len(sets)) * (width // 64), [len(s) for s in sets])
    np.bitwise_xor.at(out.reshape(-1), row + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def parities(sets: list[np.ndarray], each: int = 2) -> list[np.ndarray]:
    """For each set a bit for each of its bins: whether an odd number of its grams is there.

    Two sets differ by at least as many grams as their bits differ. Half as many bins are both halves' exclusive or.
    """
    widths = [bins(len(s), each) for s in sets]
    out: list = [None] * len(sets)
    for width in set(widths):
        own = [i for i, w in enumerate(widths) if w == width]
        for i, x in zip(own, _binned([sets[i] for i in own], width), strict=True):
            out[i] = x
    return out


def folded(odd: np.ndarray, words: int) -> np.ndarray:
    """Rows of parities in so many words of 64 bins."""
    while odd.shape[1] > words:
        half = odd.shape[1] // 2
        odd = odd[:, :half] ^ odd[:, half:]
    return odd


def _zone(likeness: Likeness) -> int:
    """Hashes below this come first; a share of grams well above that of a prefix."""
    share = min(Fraction(1), Fraction(1, 5) + Fraction(3 * (likeness.of - likeness.least), 2 * likeness.of))
    return min((1 << 64) - 1, int(share * (1 << 64)))


def _chunk_rows(docs: DataFrame, n: int, likeness: Likeness, groups: int) -> DataFrame:
    """For each chunk of documents a row of what they are (q = -1), and a row of its grams for each group q.

    ``grams``: the low halves of the distinct grams; ``counts``: in how many of the chunk's documents
    each is; ``docs``: the numbers of those.
    """
    key = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("q", T.IntegerType()),
            T.StructField("grams", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("docs", T.BinaryType()),
            T.StructField("ids", T.ArrayType(key)),
            T.StructField("marks", T.ArrayType(T.LongType())),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("zoned", T.BinaryType()),
            T.StructField("sigs", T.ArrayType(T.BinaryType())),
            T.StructField("odd", T.ArrayType(T.BinaryType())),
        ]
    )
    zone = np.uint64(_zone(likeness))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        arrow = None
        for batch in batches:
            for part in chunks(batch, "text", HASHED_BYTES):
                for at in range(0, part.num_rows, CHUNK_ROWS):
                    piece = part.slice(at, CHUNK_ROWS)
                    if arrow is None:
                        arrow = pa.schema(
                            [("chunk", pa.int64()), ("q", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()),
                             ("ids", pa.list_(piece.schema.field("doc_id").type)), ("marks", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("zoned", pa.binary()), ("sigs", pa.list_(pa.binary())), ("odd", pa.list_(pa.binary()))]
                        )
                    yield pa.RecordBatch.from_pylist(rows(piece, chunk), schema=arrow)
                    chunk += 1

    def rows(piece: pa.RecordBatch, chunk: int) -> list[dict]:
        sets = gram_sets(piece.column("text"), n)
        sizes = np.array([len(s) for s in sets], np.int32)
        zoned = np.array([np.searchsorted(s, zone) for s in sets], np.int32)
        sent = np.where(sizes > 0, np.maximum(zoned, likeness.prefix(sizes)), 0)
        gram = np.concatenate([s[:k] for s, k in zip(sets, sent, strict=True)]) if len(sets) else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(len(sets)), sent)
        out = [{"chunk": chunk, "q": -1, "ids": piece.column("doc_id").to_pylist(), "marks": piece.column("mark").to_pylist(), "sizes": sizes.tolist(), "zoned": zoned.astype("<i4").tobytes(), "sigs": [signature(s) for s in sets], "odd": [x.tobytes() for x in parities(sets)]}]
        q = ((gram >> np.uint64(32)) & np.uint64(0xFFFFFFF)) % np.uint64(groups)
        low = gram & np.uint64(0xFFFFFFFF)
        order = np.argsort(q << np.uint64(32) | low, kind="stable")
        q, low, doc = q[order], low[order], doc[order]
        cuts = np.searchsorted(q, np.arange(groups + 1))
        for k in range(groups):
            a, b = cuts[k], cuts[k + 1]
            if a < b:
                new = np.concatenate([[True], low[a + 1 : b] != low[a : b - 1]])
                first = np.flatnonzero(new)
                counts = np.diff(np.append(first, b - a))
                out.append({"chunk": chunk, "q": k, "grams": low[a:b][first].astype("<u4").tobytes(), "counts": counts.astype("<u2").tobytes(), "docs": doc[a:b].astype("<u2").tobytes()})
        return out

    return docs.mapInArrow(cut, schema)


def _grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[dict]]:
    """Runs of rows with equal keys, from sorted batches."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(held[-1][k] != row[k] for k in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _firsts(rows: DataFrame) -> DataFrame:
    """For each chunk a bit for each of its documents, sixty-four a word: whether its set is the first of equal ones."""
    sets = rows.where("q = -1").select("chunk", F.posexplode("sigs").alias("place", "sig"))
    first = sets.groupBy("sig").agg(F.min(F.struct("chunk", "place")).alias("at")).select("at.chunk", "at.place")
    bit = F.expr("shiftleft(1L, place % 64)")
    words = first.groupBy("chunk", F.floor(F.col("place") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("chunk").agg(F.collect_list(F.struct("word", "bits")).alias("firsts"))


def _is_first(firsts: list[dict] | None, size: int) -> np.ndarray:
    """Of so many documents of a chunk."""
    out = np.zeros(-(-size // 64), "<i8")
    for x in firsts or []:
        out[x["word"]] = x["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little")[:size].astype(bool)


def _distinct_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows' grams, counted in the first of equal sets only."""
    for batch in batches:
        counts = []
        for row in batch.select(["counts", "docs", "firsts"]).to_pylist():
            old, docs = np.frombuffer(row["counts"], "<u2").astype(np.int64), np.frombuffer(row["docs"], "<u2")
            first = _is_first(row["firsts"], CHUNK_ROWS)[docs]
            counts.append(np.add.reduceat(first, np.cumsum(old) - old, dtype=np.int64).astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("chunk", "q", "grams")), pa.array(counts, pa.binary())], names=["chunk", "q", "grams", "counts"])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk's row of a group, aligned with its grams: 0 for a gram of one set only, else 1 + log2 of how many have it."""
    for rows in _grouped(batches, "q"):
        grams = [np.frombuffer(r["grams"], "<u4") for r in rows]
        counts = np.concatenate([np.frombuffer(r["counts"], "<u2") for r in rows]).astype(np.int64)
        distinct, where = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(where, weights=counts, minlength=len(distinct)).astype(np.int64)
        kind = np.where(total > 1, 1 + np.floor(np.log2(np.maximum(total, 1))), 0).astype(np.uint8)[where]
        ends = np.cumsum([len(g) for g in grams])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["chunk"] for r in rows], pa.int64()),
                pa.array([r["q"] for r in rows], pa.int32()),
                pa.array([kind[e - len(g) : e].tobytes() for e, g in zip(ends, grams, strict=True)], pa.binary()),
            ],
            names=["chunk", "q", "kinds"],
        )


def _shared_beginnings(likeness: Likeness):
    """From all rows of a chunk: (gram, sig, n, held) for the grams at the beginnings of its sets, each the first of equal ones, that other sets have too; ``held`` is their number."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, "chunk"):
            about = next(r for r in rows if r["q"] == -1)
            sizes, zoned = np.array(about["sizes"], np.int64), np.frombuffer(about["zoned"], "<i4").astype(np.int64)
            kinds = {r["q"]: r["kinds"] for r in rows if r["kinds"] is not None}
            gram, doc, kind = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
            for r in rows:
                if r["grams"] is not None:
                    own = np.frombuffer(kinds[r["q"]], np.uint8)
                    counts = np.frombuffer(r["counts"], "<u2")
                    kind.append(np.repeat(own, counts))
                    gram.append(np.repeat(np.frombuffer(r["grams"], "<u4").astype(np.uint64) | np.uint64(r["q"]) << np.uint64(32), counts))
                    doc.append(np.frombuffer(r["docs"], "<u2").astype(np.int64))
            gram, doc, kind = np.concatenate(gram), np.concatenate(doc), np.concatenate(kind)
            shared = (kind > 0) & _is_first(about["firsts"], len(sizes))[doc]
            gram, doc, kind = gram[shared], doc[shared], kind[shared]
            order = np.lexsort((gram, kind, doc))
            gram, doc = gram[order], doc[order]
            held = np.bincount(doc, minlength=len(sizes))
            rank = np.arange(len(doc)) - np.repeat(np.cumsum(held) - held, held)
            # of the zone's grams, those that no other has come first; all that a set with a small zone has sent counts
            room = np.where(zoned >= likeness.prefix(sizes), likeness.prefix(sizes) - (zoned - held), held)
            kept = rank < room[doc]
            gram, doc = gram[kept], doc[kept]
            held = np.bincount(doc, minlength=len(sizes))
            for a in range(0, len(gram), 100_000):
                d = doc[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram[a : a + 100_000].view(np.int64)), pa.array([about["sigs"][i] for i in d], pa.binary()), pa.array(sizes[d].astype(np.int32)), pa.array(held[d].astype(np.int32))],
                    names=["gram", "sig", "n", "held"],
                )

    return find


def links(sets: list[np.ndarray], likeness: Likeness, known: list | None = None, probes: list[bool] | None = None) -> list[tuple[int, int]]:
    """Pairs whose links connect the sets as all links do; with ``probes``, only links of those with the others.

    Sets with equal ``known`` are connected beforehand. From the smallest set on, each is held against the
    smaller ones whose size allows a link.
    """
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size, asks = size[order], None if probes is None else np.array(probes, bool)[order]
    sets = [sets[i] for i in order]
    group = np.arange(len(sets))
    if known is not None:
        firsts: dict = {}
        for i, k in enumerate(known[j] for j in order):
            if k is not None:
                group[i] = firsts.setdefault(k, i)
    widths = np.array([bins(n, 4) for n in size.tolist()])
    starts = np.flatnonzero(np.concatenate([[True], widths[1:] != widths[:-1]]))
    tiers = [(a, b, _binned(sets[a:b], int(widths[a]))) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(sets)], strict=True)]
    found = []
    for x in range(len(sets)):
        n = int(size[x])
        low = int(np.searchsorted(size, -(-likeness.least * n // likeness.of)))
        near = group[low:x] != group[x]
        if asks is not None:
            near &= asks[low:x] != asks[x]
        if n == 0 or not near.any():
            continue
        maybe, own = [], next(odd[x - a : x - a + 1] for a, b, odd in tiers if a <= x < b)
        for a, b, odd in tiers:
            a_, b_ = max(a, low), min(b, x)
            if a_ < b_ and near[a_ - low : b_ - low].any():
                differ = np.bitwise_count(odd[a_ - a : b_ - a] ^ folded(own, odd.shape[1])).sum(axis=1, dtype=np.int64)
                maybe.append(a_ + np.flatnonzero(near[a_ - low : b_ - low] & (differ <= likeness.difference(n, size[a_:b_]))))
        rest, batch = np.concatenate(maybe), 8
        while len(rest):
            some, rest = rest[:batch], rest[batch:]
            grams = np.concatenate([sets[y] for y in some])
            same = sets[x][np.minimum(np.searchsorted(sets[x], grams), n - 1)] == grams
            common = np.add.reduceat(same, np.cumsum(size[some]) - size[some], dtype=np.int64)
            for y in some[common >= likeness.overlap(n, size[some])].tolist():
                if group[y] != group[x]:
                    found.append((int(order[x]), int(order[y])))
                    group[group == group[y]] = group[x]
            rest, batch = rest[group[rest] != group[x]], 2 * batch
    return found


def _local_links(likeness: Likeness, *keys: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, *keys):
            sets = [np.frombuffer(r["grams"], "<u8") for r in rows]
            probes = [r["probe"] for r in rows]
            pairs = links(sets, likeness, [r["known"] for r in rows], probes if any(probes) else None)
            if pairs:
                # links of equal sets, in a block twice as probe and member, are none
                edges = stars([r["sig"] for r in rows], pairs)
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return find


def _joined(sets: DataFrame, likeness: Likeness) -> DataFrame:
    """Edges found within each (cluster, block) of ``sets`` (cluster, block, sig, grams, known, probe)."""
    dealt = sets.repartition(partitions(sets), "cluster", "block").sortWithinPartitions("cluster", "block", "sig", "probe")
    return dealt.mapInArrow(_local_links(likeness, "cluster", "block"), "a binary, b binary")


def _begins(likeness: Likeness) -> Column:
    """Grams at the beginning of a set of size ``n``."""
    return F.col("n") - F.ceil(F.col("n") * likeness.least / likeness.of) + 1


def _blocked(sets: DataFrame, likeness: Likeness) -> DataFrame:
    """``sets`` with ``blocks`` of its cluster, as many as keep a block small, its own ``block``, and whether all blocks meet (``paired``)."""
    begins = F.sum(_begins(likeness))
    sizes = sets.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(float(GRAMS_JOINED))).cast("int").alias("blocks"), (2 * begins).alias("begins"), F.count(F.lit(1)).alias("members"))
    sizes = sizes.select("cluster", "blocks", (F.col("blocks") * F.col("members") <= F.greatest("begins", "members")).alias("paired"))
    return sets.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int"))


def _edges(sets: DataFrame, shared: DataFrame, likeness: Likeness) -> DataFrame:
    """Edges that connect the sets (cluster, sig, n, grams) of each cluster as all links do.

    A cluster too large for one task is cut into blocks, each of which meets every other one. Where its
    sets would then be read more often than they have grams at their beginnings, each block is joined for itself, then one set
    of each found group with those of other blocks, which connects most copies. A set outside of its cluster's largest group then
    meets just the sets with which it shares a gram of its beginning and a band of sizes, as linked ones do
    (``shared``: gram, sig, n); so a cluster held together by chance costs as much as these groups are large.
    """
    blank = {"known": F.lit(None).cast("binary"), "probe": F.lit(False)}
    blocked = written(_blocked(sets, likeness), "sets")
    edges = written(_joined(_paired(blocked.where("paired").withColumns(blank)), likeness), "links")
    large = blocked.where("NOT paired").drop("paired")
    if large.isEmpty():
        return edges
    edges = written(edges.union(_joined(large.withColumns(blank), likeness)).distinct(), "links")
    for _ in range(2):
        roots = components(edges).withColumnRenamed("node", "sig")
        placed = large.join(roots, "sig", "left").withColumn("known", F.coalesce("root", "sig")).drop("root")
        firsts = placed.where("sig = known").drop("blocks", "block", "known")
        more = _joined(_blocked(firsts, likeness).withColumns(blank), likeness)
        edges = written(edges.union(more).distinct(), "links")
    roots = components(edges).withColumnRenamed("node", "sig")
    placed = written(large.join(roots, "sig", "left").withColumn("known", F.coalesce("root", "sig")).drop("root"), "sets")
    return edges.union(_joined(written(_by_beginnings(placed, _banded(shared, likeness)), "groups"), likeness)).distinct()


def _paired(blocked: DataFrame) -> DataFrame:
    """``blocked`` dealt to the pairs of its cluster's blocks, the later block as probes, and to each block with itself."""
    j, block, blocks = F.col("j"), F.col("block").cast("long"), F.col("blocks")
    pair = blocked.withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return pair.withColumns({"probe": block > j, "block": F.least(block, j) * blocks + F.greatest(block, j)}).drop("j", "paired")


def _banded(shared: DataFrame, likeness: Likeness) -> DataFrame:
    """Each row twice, with a ``band`` of sizes: sets that are linked are so near in size that they share one of two neighbouring ones."""
    band = F.floor(F.log("n") / F.log(F.lit(likeness.of / likeness.least) * 1.0001)).cast("int")
    return shared.withColumn("band", F.explode(F.array(band, band + 1)))


def _by_beginnings(placed: DataFrame, shared: DataFrame) -> DataFrame:
    """``placed`` dealt to the (gram, band) groups of their beginnings that are not connected yet.

    A group of too many grams for one task is cut into blocks, all of which the sets outside of the
    cluster's largest group are compared with.
    """
    groups = placed.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("members"))
    largest = groups.groupBy("cluster").agg(F.max_by("known", F.struct("members", "known")).alias("largest"))
    asked = placed.join(largest, "cluster").withColumn("asks", F.col("known") != F.col("largest"))
    key = F.concat_ws("/", "gram", "band").cast("binary").alias("cluster")
    about = shared.select(key, "sig").join(asked.select("sig", "n", "known", "asks"), "sig")
    open_ = about.groupBy("cluster").agg(
        F.min("known").alias("low"), F.max("known").alias("high"), F.max("asks").alias("asked"), F.ceil(F.sum("n") / F.lit(float(GRAMS_JOINED))).cast("int").alias("blocks")
    )
    open_ = open_.where("asked AND low <> high").select("cluster", "blocks")
    dealt = about.join(open_, "cluster").join(placed.select("sig", "grams"), "sig")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")).withColumn("probe", F.lit(False))
    probes = dealt.where("asks AND blocks > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("probe", F.lit(True))
    return dealt.unionByName(probes)


def _compared(likeness: Likeness):
    """The pairs (a, b, n, m, odd_a, odd_b) that may be linked by their sizes and parities, as (a, b)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            odd = [batch.column(c).to_pylist() for c in ("odd_a", "odd_b")]
            sizes = np.array([[len(x) // 8 for x in o] for o in odd]).reshape(2, -1)
            kept = np.zeros(batch.num_rows, bool)
            for k in {tuple(x) for x in sizes.T.tolist()}:
                own = np.flatnonzero((sizes[0] == k[0]) & (sizes[1] == k[1]))
                a, b = (np.frombuffer(b"".join(o[i] for i in own), "<u8").reshape(len(own), w) for o, w in zip(odd, k, strict=True))
                differ = np.bitwise_count(folded(a, min(k)) ^ folded(b, min(k))).sum(axis=1, dtype=np.int64)
                kept[own] = differ <= likeness.difference(n[own], m[own])
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return find


def _clusters(shared: DataFrame, known: DataFrame, likeness: Likeness) -> DataFrame:
    """(node, root) of clusters of sets: all linked ones are in one, and few others.

    A set that shares many grams of its beginning with one that has those is clustered with it unseen, and then one
    that shares an eighth of the grams kept of its beginning (``held``) with ``CROWD`` sets or more, with the largest cluster there.
    Where several clusters still have a gram, all pairs of its sets are compared
    by size and parities (``known``: sig, odd); so chance, which grows with the square of the input, holds no clusters together.
    """
    edges, rows = None, shared.withColumn("label", F.struct(F.lit(1).cast("long").alias("members"), "sig"))
    for crowd in (False, True):
        rows = rows.join(_in_several(rows, "gram"), "gram")
        near = rows.where("label <> last.label" + (f" AND sets >= {CROWD}" if crowd else ""))
        near = near.groupBy("sig", "n", "held", "label", (F.col("last.label") if crowd else F.col("last")).alias("last"))
        near = near.agg(F.count(F.lit(1)).alias("common")).withColumn("begins", _begins(likeness))
        enough = "8 * common >= held" if crowd else "4 * common >= begins OR common > 1 AND 8 * common >= begins"
        near = near.where(enough).select(F.col("label.sig").alias("a"), F.col("last.sig" if crowd else "last.label.sig").alias("b"))
        edges = written(near if edges is None else edges.union(near), "near")
        labels = components(edges)
        labels = labels.join(labels.groupBy("root").agg(F.count(F.lit(1)).alias("members")), "root").select(F.col("node").alias("sig"), "members", "root")
        label = F.struct(F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("root", "sig").alias("sig"))
        rows = written(rows.select("gram", "sig", "n", "held").join(labels, "sig", "left").select("gram", "sig", "n", "held", label.alias("label")), "near")
    rows = _banded(rows.join(_in_several(rows, "gram").select("gram"), "gram"), likeness)
    rows = rows.join(_in_several(rows, "gram", "band").select("gram", "band"), ["gram", "band"])
    a, b = (rows.select("gram", "band", F.col("sig").alias(x), F.col("n").alias(k), F.col("label.sig").alias(f"label_{x}")) for x, k in (("a", "n"), ("b", "m")))
    fits = (F.col("label_a") < F.col("label_b")) & (F.greatest("n", "m") * likeness.least <= F.least("n", "m") * likeness.of)
    pairs = a.join(b, ["gram", "band"]).where(fits).select("a", "b", "n", "m").distinct()
    for x in ("a", "b"):
        pairs = pairs.join(known.select(F.col("sig").alias(x), F.col("odd").alias(f"odd_{x}")), x)
    return components(edges.union(pairs.mapInArrow(_compared(likeness), "a binary, b binary")))


def _in_several(rows: DataFrame, *keys: str) -> DataFrame:
    """The groups of rows with more than one label, their ``last`` label and set, and number of ``sets``."""
    return rows.groupBy(*keys).agg(F.min("label").alias("first"), F.max(F.struct("label", "sig")).alias("last"), F.count(F.lit(1)).alias("sets")).where("first <> last.label").drop("first")


def similar_groups(df: DataFrame, words: int = 5, least: int = 80, of: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, mark, is_first) for every row; component_id is the smallest id reachable by links.

    Texts are cut into words at ASCII white space, with A to Z lowered; a set holds the
    distinct runs of ``words`` words (shorter texts are one run). Rows are linked if
    ``of`` * intersection >= ``least`` * union. Sets are compared by 64-bit hashes of their
    runs. Null texts and texts without words have no set and no links: their component_id
    is their own id. A null id is skipped in finding the smallest, and is null if alone.
    ``mark`` is the text's hash, and ``is_first`` tells the row of each group that stands first
    by (id, mark). Repeated rows are linked; other columns are ignored; an empty table gives an empty table.
    """
    likeness = Likeness(least, of)
    docs = pick(df, doc_id=id_col, text=text_col).withColumn("mark", F.xxhash64("text"))
    volume = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    groups = max(partitions(df), volume * _zone(likeness) // (6 * GRAMS_COUNTED << 64))
    rows = written(_chunk_rows(docs, words, likeness, groups), "grams")
    # a bit for each document, so that repeated sets count once
    rows = rows.join(F.broadcast(_firsts(rows)), "chunk", "left")
    counted = rows.where("q >= 0").select("chunk", "q", "grams", "counts", "docs", "firsts").mapInArrow(_distinct_counts, "chunk long, q int, grams binary, counts binary")
    dealt = counted.repartition(groups, "q").sortWithinPartitions("q")
    kinds = dealt.mapInArrow(_frequencies, "chunk long, q int, kinds binary")
    wide = ["chunk", "q", "grams", "counts", "docs", "sizes", "zoned", "sigs", F.when(F.col("q") == -1, F.col("firsts")).alias("firsts")]
    both = rows.select(*wide).withColumn("kinds", F.lit(None).cast("binary")).unionByName(kinds, allowMissingColumns=True)
    shared = both.repartition(groups, "chunk").sortWithinPartitions("chunk").mapInArrow(_shared_beginnings(likeness), "gram long, sig binary, n int, held int")
    shared = written(shared, "shared")
    about = rows.where("q = -1")
    odd = about.select(F.explode(F.arrays_zip("sigs", "odd")).alias("x")).select(F.col("x.sigs").alias("sig"), F.col("x.odd").alias("odd"))
    clusters = _clusters(shared, odd.dropDuplicates(["sig"]), likeness)

    known = about.select(F.explode(F.arrays_zip("ids", "marks", "sizes", "sigs")).alias("x"))
    known = known.select(F.col("x.ids").alias("doc_id"), F.col("x.marks").alias("mark"), F.col("x.sizes").alias("n"), F.col("x.sigs").alias("sig"))
    wanted = known.join(clusters.select(F.col("node").alias("sig"), F.col("root").alias("cluster")), "sig")
    wanted = wanted.groupBy("sig", "cluster").agg(F.min(F.struct("doc_id", "mark")).alias("one"))
    wanted = wanted.select("sig", "cluster", F.col("one.doc_id").alias("one_id"), F.col("one.mark").alias("one_mark"))
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("mark") == F.col("one_mark"))).select("text", "sig", "cluster")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", HASHED_BYTES):
                sets = gram_sets(part.column("text"), words)
                # texts with equal ids and marks can still differ
                true = pa.array([signature(s) == sig for s, sig in zip(sets, part.column("sig").to_pylist(), strict=True)], pa.bool_())
                data = pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())
                sizes = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("cluster"), part.column("sig"), sizes, data], names=["cluster", "sig", "n", "grams"]).filter(true)

    sets = texts.mapInArrow(full, "cluster binary, sig binary, n long, grams binary").dropDuplicates(["sig"])
    roots = components(_edges(sets, shared, likeness))
    placed = known.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    own = F.struct(F.isnull("doc_id"), "doc_id", "mark")
    firsts = placed.groupBy("root").agg(F.min("doc_id").alias("smallest"), F.min(own).alias("first"))
    return placed.join(firsts, "root").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        "mark",
        ((F.col("n") == 0) | own.eqNullSafe(F.col("first"))).alias("is_first"),
    )


def one_of_each_group(df: DataFrame, words: int = 5, least: int = 80, of: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each group of similar texts: that with the smallest (id, text hash), null ids last.

    Rows without a set all stay, but of rows that repeat both id and text one stays. All
    columns are kept.
    """
    names = df.columns
    groups = similar_groups(df, words, least, of, id_col, text_col)
    gone = groups.where("NOT is_first").select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    rows = packed(df, id=id_col, text=text_col).withColumn("mark", F.xxhash64("text"))
    rows = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("mark") == F.col("gone_mark")), "left_anti")
    rows = rows.dropDuplicates(["id", "mark"])
    return rows.select(*(F.col(f"row._c{i}").alias(n) for i, n in enumerate(names)))
