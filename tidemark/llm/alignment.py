"""Tokens of two tokenizers linked where their byte ranges overlap, and how common each link is.

Texts are encoded once, each distinct word of a batch for itself, and their ids stored. A first pass over the ids aligns them and collects
the distinct id pairs of each task with the number of documents that hold them. A minimal
perfect hash of all distinct pairs numbers them; the tasks' numbers become dense vectors
that are summed in a tree. A second pass aligns the ids again and looks each link up: the hash
gives its place, and the pair kept there must be the pair itself.

Pairs are dealt to shards by hash and taken in blocks of bounded size, each with a pass of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import pick
from tidemark.llm.hashing import compacted
from tidemark.llm.mph import MOST_LEVELS, PerfectHash, built, spread
from tidemark.llm.tokens import chunks
from tidemark.session import discard, written

#: Pairs of a shard on average, and of a block at most: a block's hash, pairs and counts (13 bytes a
#: pair) pass the driver and are broadcast. Numbers of a vector that are sent together, and vectors one task adds.
SHARD_PAIRS = 1 << 15
BLOCK_PAIRS = 1 << 22
PIECE = 1 << 16
FAN_IN = 16
#: Bytes of text to encode, bytes of ids to align, and distinct pairs that a task holds, at a time.
TEXT_BYTES = 2 << 20
ID_BYTES = 1 << 19
HELD_PAIRS = 1 << 20
#: Words that the piece tokenizer gets as one text.
JOINED_WORDS = 16

#: How ids are stored.
ID = "<u2"

#: The pattern that byte-level tokenizers of this kind cut texts by.
BYTE_LEVEL_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself where printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Bytes:
    """The bytes of every id, laid in a row."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int32)
        self.start = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(entries), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        size = self.length[ids]
        ends = np.cumsum(size)
        return self.raw[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class ByteTokenizer:
    """A byte-level BPE from its JSON file; special tokens' strings are plain text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        about = json.loads(self.exact.to_str())
        model, special = about["model"], {t["id"] for t in about["added_tokens"] if t["special"]}
        byte = byte_alphabet()
        vocabulary = {i: t.encode() if i in special else bytes(byte[c] for c in t) for t, i in model["vocab"].items()}
        vocabulary |= {t["id"]: t["content"].encode() for t in about["added_tokens"]}
        self.bytes = _Bytes([vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)])
        # merges in the order of the ids they make are ranks, which another library merges by faster
        made = [model["vocab"]["".join(m)] for m in (tuple(m.split(" ")) if isinstance(m, str) else m for m in model["merges"])]
        ranked = made == list(range(256, 256 + len(made))) and not model.get("ignore_merges") and not about["normalizer"]
        self.fast = None
        if ranked and about["pre_tokenizer"]["type"] == "ByteLevel" and about["pre_tokenizer"].get("use_regex", True):
            ranks = {vocabulary[i]: i for i in range(256 + len(made))}
            self.fast = tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as e:  # its pattern engine panics on some very long runs
                if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)


class PieceTokenizer:
    """A sentencepiece model with byte fallback, which puts a space before the text.

    ``words_apart`` says that no piece goes on over the beginning of a word.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = self.model.is_byte
        self.bytes = _Bytes([bytes([int(p[3:5], 16)]) if byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

        self.words_apart = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, words: list[str]) -> np.ndarray:
        """The ids of the words with a space before each; a long text takes longer than its parts."""
        parts = [" ".join(words[i : i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        return np.fromiter(chain.from_iterable(self.model.encode(parts, num_threads=1)), np.int64)


#: A space that begins a word, after which neither tokenizer looks back; and texts with spaces of other kinds.
WORD_START = re.compile(r"(?<=[^ ▁]) (?=\S)")
OTHER_SPACES = r"^[\s\p{Z}\x{85}]| $| [\s\p{Z}\x{85}]|▁ "
#: Words that cannot stand between others: empty, or with a beginning or an end that could join its neighbour.
ALONE = r"^$|^[\s\p{Z}\x{85}]|[ ▁]$"


class WordPairs:
    """Ids of texts under both tokenizers, word by word; a text that either one does not give back has none.

    A word is what stands between two spaces that begin a word. Neither a match of the byte-level pattern nor a
    piece goes over such a place, so the ids of a text are those of its words in a row. The distinct
    words of a batch are encoded as one text.
    """

    def __init__(self, first: ByteTokenizer, second: PieceTokenizer):
        self.first, self.second = first, second
        self.apart = first.fast is not None and second.words_apart

    def _words(self, texts: pa.LargeStringArray) -> tuple[pa.Array, np.ndarray]:
        """All words, and the texts' bounds in them."""
        if not self.apart:
            return texts, np.arange(len(texts) + 1)
        if pc.any(pc.match_substring_regex(texts, OTHER_SPACES)).as_py():
            words = [WORD_START.split(t) for t in texts.to_pylist()]
            return pa.array([w for own in words for w in own], pa.large_string()), np.cumsum([0, *map(len, words)])
        words = pc.split_pattern(texts, " ")
        return words.flatten(), words.offsets.to_numpy() - words.offsets[0].as_py()

    def _encoded(self, words: list[str], sizes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Both tokenizers' ids of the words in a row, how many each word has, and the words that are not given back."""
        text = " ".join(words)
        raw = np.frombuffer(f" {text}".encode(), np.uint8)
        ids = [self.first.encode(f" {text}"), self.second.encode(words)] if text else [np.zeros(0, np.int64)] * 2
        if all(np.array_equal(t.bytes.of(i), raw) for t, i in zip((self.first, self.second), ids, strict=True)):
            ends = np.cumsum(sizes + 1)
            places = [np.searchsorted(np.cumsum(t.bytes.length[i]), ends) + 1 for t, i in zip((self.first, self.second), ids, strict=True)]
            return ids, [np.diff(p, prepend=0) for p in places], np.zeros(len(words), bool)
        if len(words) == 1:
            return [np.zeros(0, np.int64)] * 2, [np.zeros(1, np.int64)] * 2, np.ones(1, bool)
        half = len(words) // 2
        return _joined([self._encoded(words[:half], sizes[:half]), self._encoded(words[half:], sizes[half:])])

    def encode(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The texts' ids under both, as arrays of little-endian numbers of type ID."""
        texts = compacted(texts)[2]
        words, bounds = self._words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        sizes = pc.binary_length(distinct).to_numpy(zero_copy_only=False).astype(np.int64)
        alone = pc.match_substring_regex(distinct, ALONE).to_numpy(zero_copy_only=False) if self.apart else np.ones(len(distinct), bool)
        order = np.argsort(alone, kind="stable")
        listed = distinct.take(pa.array(order)).to_pylist()
        together = int(len(listed) - alone.sum())
        groups = [slice(0, together)] if together else []
        groups += [slice(i, i + 1) for i in range(together, len(listed))]
        ids, counts, lost = _joined([self._encoded(listed[g], sizes[order[g]]) for g in groups])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        code = place[coded.indices.to_numpy(zero_copy_only=False)]
        none = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).copy()
        before = np.concatenate([[0], np.cumsum(lost[code])])
        none |= before[bounds[1:]] > before[bounds[:-1]]
        code = code[~np.repeat(none, np.diff(bounds))]
        kept = np.concatenate([[0], np.cumsum(np.where(none, 0, np.diff(bounds)))])
        return tuple(_gathered(i.astype(ID), n, code, kept) for i, n in zip(ids, counts, strict=True))


def _joined(parts: list) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    if not parts:
        return [np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 2, np.zeros(0, bool)
    ids, counts = ([np.concatenate([p[k][side] for p in parts]) for side in (0, 1)] for k in (0, 1))
    return ids, counts, np.concatenate([p[2] for p in parts])


def _gathered(ids: np.ndarray, size: np.ndarray, code: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values, each the ids of a run of codes in a row; ``size`` says how many ids each code has."""
    start = np.cumsum(size) - size
    length = size[code]
    ends = np.cumsum(length)
    at = np.repeat(start[code] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
    stops = np.concatenate([[0], ends])[bounds] * ids.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(stops.astype(np.int64)), pa.py_buffer(ids[at])])


_LOADED: dict[tuple[str, str], WordPairs] = {}


def _loaded(byte_path: str, piece_path: str) -> WordPairs:
    """This worker's tokenizers; they are loaded once."""
    if (byte_path, piece_path) not in _LOADED:
        _LOADED[byte_path, piece_path] = WordPairs(ByteTokenizer(byte_path), PieceTokenizer(piece_path))
    return _LOADED[byte_path, piece_path]


class Lengths(NamedTuple):
    """How many bytes each id of the two tokenizers stands for."""

    first: np.ndarray
    second: np.ndarray


def _lengths(byte_path: str, piece_path: str) -> Lengths:
    tokenizers = ByteTokenizer(byte_path), PieceTokenizer(piece_path)
    if max(len(t.bytes.length) for t in tokenizers) > np.iinfo(ID).max:
        raise ValueError("more ids than fit the stored type")
    return Lengths(*(t.bytes.length for t in tokenizers))


def encoded(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, a, b): the ids of every text under both tokenizers, as little-endian numbers of type ID.

    They are empty for texts that are null or empty, or that either tokenizer does not give back byte for byte.
    """
    docs = pick(df, doc_id=id_col, text=text_col)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, a binary, b binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded(byte_path, piece_path)
        for batch in batches:
            for part in chunks(batch, "text", TEXT_BYTES):
                a, b = both.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), a.cast(pa.binary()), b.cast(pa.binary())], names=["doc_id", "a", "b"])

    return docs.mapInArrow(encode, schema)


class Aligned:
    """Links and groups of a batch of texts: where the tokens of both tokenizers end, over all texts in a row."""

    def __init__(self, batch: pa.RecordBatch, lengths: Lengths):
        (self.a, self.a_bounds), (self.b, self.b_bounds) = _ids(batch.column("a")), _ids(batch.column("b"))
        self.width = len(lengths.second)
        self.a_ends, self.b_ends = np.cumsum(lengths.first[self.a]), np.cumsum(lengths.second[self.b])
        # each text's last tokens end together, so both mark the same last byte
        size = int(self.a_ends[-1]) if len(self.a) else 0
        a_mark, b_mark = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        a_mark[self.a_ends] = b_mark[self.b_ends] = True
        ends = np.flatnonzero(a_mark | b_mark)
        # the token that reaches each end is the first that ends there or later
        link_a, link_b = np.cumsum(a_mark, dtype=np.int32)[ends] - a_mark[ends], np.cumsum(b_mark, dtype=np.int32)[ends] - b_mark[ends]
        #: the pair of each link, and each text's links
        self.pairs = self.a[link_a].astype(np.uint32) * np.uint32(self.width) + self.b[link_b]
        stops = np.concatenate([[0], self.a_ends])[self.a_bounds]
        before = np.concatenate([np.cumsum(a_mark | b_mark, dtype=np.int32), [0]])
        self.bounds = before[stops]
        self.common = a_mark & b_mark
        self.groups_until = np.cumsum(self.common, dtype=np.int32)
        self.n_groups = np.diff(self.groups_until[stops])

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums of the links' values by text."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def distinct_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs, and how many of the texts hold each."""
        text = np.repeat(np.arange(len(self.bounds) - 1, dtype=np.uint64), np.diff(self.bounds))
        both = np.sort(text << np.uint64(32) | self.pairs)
        pair = np.sort((both[_fresh(both)] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        first = np.flatnonzero(_fresh(pair))
        return pair[first].astype(np.int64), np.diff(np.append(first, len(pair)))

    def group_texts(self) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        a_last, b_last = self.common[self.a_ends], self.common[self.b_ends]
        a_group, b_group = self.groups_until[self.a_ends] - a_last, self.groups_until[self.b_ends] - b_last
        groups = int(self.groups_until[-1])
        # within a group all tokens of the first tokenizer stand before those of the second
        a_until = np.cumsum(np.bincount(a_group, minlength=groups))
        b_until = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=groups))])
        a_place, b_place = np.arange(len(self.a)) + b_until[a_group], np.arange(len(self.b)) + a_until[b_group]
        ids, sign = np.empty(len(self.a) + len(self.b), np.int32), np.empty(len(self.a) + len(self.b), np.uint8)
        ids[a_place], ids[b_place] = self.a, self.b
        sign[a_place], sign[b_place] = np.where(a_last, ord("|"), ord(",")), np.where(b_last, ord(";"), ord(","))
        digits, length = _digits(int(ids.max()) if len(ids) else 0)
        size = length[ids] + 1
        table = digits[ids]
        table[np.arange(len(ids)), size - 1] = sign
        raw = table[np.arange(table.shape[1], dtype=np.int32) < size[:, None]].tobytes()
        stops = np.concatenate([[0], np.cumsum(size)])[self.a_bounds + self.b_bounds]
        return [raw[s : e - 1] if e > s else b"" for s, e in zip(stops[:-1], stops[1:], strict=True)]


def _fresh(ordered: np.ndarray) -> np.ndarray:
    """Where a sorted array has a new value."""
    fresh = np.ones(len(ordered), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return fresh


_DIGITS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0 to a number above ``most``, from the left with room for a sign, and how many there are."""
    size = 1 << most.bit_length()
    if size not in _DIGITS:
        text = np.arange(size).astype(f"S{len(str(size)) + 1}")
        _DIGITS[size] = text.view(np.uint8).reshape(size, -1), np.char.str_len(text).astype(np.int32)
    return _DIGITS[size]


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw, bounds, _ = compacted(column.cast(pa.large_binary()).view(pa.large_string()))
    return np.frombuffer(raw.tobytes(), ID), bounds // np.dtype(ID).itemsize


def _aligned(batches: Iterator[pa.RecordBatch], lengths: Lengths) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    for batch in batches:
        for part in chunks(batch, "a", ID_BYTES):
            yield part, Aligned(part, lengths)


def _shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    return (spread(pairs, MOST_LEVELS) % np.uint64(shards)).astype(np.int64)


def document_counts(stored: DataFrame, lengths: Lengths) -> DataFrame:
    """(pair, n): how many documents hold a linked pair, in parts; a task has several rows for a pair where it has very many pairs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for _, links in _aligned(batches, lengths):
            held.append(links.distinct_pairs())
            size += len(held[-1][0])
            if size >= HELD_PAIRS:
                held = [_summed(held)]
                size = len(held[0][0])
                if size >= HELD_PAIRS // 2:
                    yield _table(held[0])
                    held, size = [], 0
        if held:
            yield _table(_summed(held))

    return stored.mapInArrow(counted, "pair long, n long")


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, n = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.argsort(pairs, kind="stable")
    pairs, n = pairs[order], n[order]
    first = np.flatnonzero(_fresh(pairs))
    return pairs[first], np.add.reduceat(n, first) if len(n) else n


def _table(counts: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in counts], names=["pair", "n"])


def hashed_shards(parts: DataFrame, shards: int) -> DataFrame:
    """(shard, n, sizes, words, pairs): a perfect hash of each shard's distinct pairs, and the pairs in its order."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column("pair").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("pair"), pa.array(_shard(pairs, shards))], names=["pair", "shard"])

    def build(table: pa.Table) -> pa.Table:
        pairs = table.column("pair").to_numpy()
        sizes, words = built(pairs)
        own = PerfectHash.joined([(sizes, words)])
        ordered = np.empty(len(pairs), "<u4")
        ordered[own.index(pairs, np.zeros(len(pairs), np.int64))] = pairs
        row = {"shard": table.column("shard")[:1], "n": [len(pairs)], "sizes": [sizes.tobytes()], "words": [words.tobytes()], "pairs": [ordered.tobytes()]}
        return pa.table(row)

    distinct = parts.select("pair").distinct().mapInArrow(numbered, "pair long, shard long")
    return distinct.groupBy("shard").applyInArrow(build, "shard long, n long, sizes binary, words binary, pairs binary")


class Block:
    """The pairs of some shards in the order of their perfect hash."""

    def __init__(self, rows: list, shards: int):
        """``rows`` are those of ``hashed_shards``; a shard without a row has no pairs."""
        self.shards = shards
        self.place = np.full(shards, -1, np.int64)
        self.place[[r["shard"] for r in rows]] = np.arange(len(rows))
        self.hash = PerfectHash.joined([(np.frombuffer(r["sizes"], np.int64), np.frombuffer(r["words"], np.uint64)) for r in rows])
        self.pairs = np.frombuffer(b"".join(r["pairs"] for r in rows), "<u4")

    def index(self, pairs: np.ndarray) -> np.ndarray:
        """Each pair's place, or -1 where the pair kept there is another one, or none."""
        place = self.place[_shard(pairs, self.shards)]
        out = np.full(len(pairs), -1, np.int64)
        mine = np.flatnonzero(place >= 0)
        found = self.hash.index(pairs[mine], place[mine])
        out[mine] = np.where((found >= 0) & (self.pairs[found] == pairs[mine]), found, -1) if len(self.pairs) else -1
        return out


def tree_summed(parts: DataFrame, block: Block) -> DataFrame:
    """(piece, task, counts): the counts of a block's pairs over all parts; each task's dense vector in pieces, added up in rounds."""
    size = len(block.pairs)
    shared = parts.sparkSession.sparkContext.broadcast(block)
    schema = "piece int, task int, counts binary"

    def row(piece: int, task: int, counts: np.ndarray) -> dict:
        return {"piece": pa.array([piece], pa.int32()), "task": pa.array([task], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())}

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            place = shared.value.index(batch.column("pair").to_numpy(zero_copy_only=False))
            np.add.at(counts, place[place >= 0], batch.column("n").to_numpy(zero_copy_only=False)[place >= 0])
        task = TaskContext.get().partitionId()
        for piece in range(-(-size // PIECE)):
            part = counts[piece * PIECE : (piece + 1) * PIECE]
            if part.any():
                yield pa.RecordBatch.from_pydict(row(piece, task, part))

    def added(table: pa.Table) -> pa.Table:
        vectors = (np.frombuffer(v.as_buffer(), np.int64) for v in table.column("counts"))
        return pa.table(row(table.column("piece")[0].as_py(), table.column("task")[0].as_py() // FAN_IN, reduce(np.add, vectors)))

    vectors, tasks = parts.mapInArrow(dense, schema), parts.rdd.getNumPartitions()
    while tasks > 1:
        vectors = vectors.groupBy("piece", F.expr(f"task div {FAN_IN}").alias("task_group")).applyInArrow(added, schema)
        tasks = -(-tasks // FAN_IN)
    summed = written(vectors, "alignment_counts")
    shared.unpersist()
    return summed


def _vector(summed: DataFrame, size: int) -> np.ndarray:
    total = np.zeros(size, np.int64)
    for r in summed.collect():
        total[r.piece * PIECE : (r.piece + 1) * PIECE] = np.frombuffer(r.counts, np.int64)
    return total


def looked_up(stored: DataFrame, block: Block, counts: np.ndarray, best: np.ndarray, lengths: Lengths) -> DataFrame:
    """Every document's measures; n_best and count_sum over the links whose pairs are in the block."""
    shared = stored.sparkSession.sparkContext.broadcast((block, counts, best))
    names = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    longs = ", ".join(f"{c} long" for c in names[2:8])
    schema = f"uid long, doc_id {stored.schema['doc_id'].dataType.simpleString()}, {longs}, groups_sha256 string"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, best = shared.value
        for part, links in _aligned(batches, lengths):
            place = block.index(links.pairs.astype(np.int64))
            n = np.where(place >= 0, counts[place], 0) if len(counts) else np.zeros(len(place), np.int64)
            top = (place >= 0) & (n == best[links.pairs // links.width])
            measures = [np.diff(links.a_bounds), np.diff(links.b_bounds), links.n_groups, np.diff(links.bounds), links.per_text(top), links.per_text(n)]
            digest = [hashlib.sha256(t).hexdigest() if t else "" for t in links.group_texts()]
            columns = [pa.array(m.astype(np.int64)) for m in measures]
            yield pa.RecordBatch.from_arrays([part.column("uid"), part.column("doc_id"), *columns, pa.array(digest, pa.string())], names=names)

    return stored.mapInArrow(measure, schema)


def aligned_documents(df: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    Texts that are null or empty, or that a tokenizer does not give back byte for byte, have no tokens:
    zeros and an empty ``groups_sha256``. Repeated rows are documents of their own. Other columns are
    ignored. An empty table gives no rows.
    """
    uid = F.monotonically_increasing_id().alias("uid")
    stored = written(encoded(df, byte_path, piece_path, id_col, text_col).select(uid, "doc_id", "a", "b"), "alignment_ids")
    lengths = _lengths(byte_path, piece_path)
    parts = written(document_counts(stored, lengths), "alignment_parts")
    total = parts.agg(F.approx_count_distinct("pair")).first()[0]
    shards = max(1, -(-total // SHARD_PAIRS))
    hashed = written(hashed_shards(parts, shards), "alignment_hash")
    width = len(lengths.second)
    best = np.zeros(len(lengths.first), np.int64)
    step = max(1, BLOCK_PAIRS // SHARD_PAIRS)
    starts = range(0, shards, step)

    def block(first: int) -> Block:
        return Block(hashed.where(F.col("shard").between(first, first + step - 1)).collect(), shards)

    summed = []
    for first in starts:
        now = block(first)
        summed.append(tree_summed(parts, now))
        np.maximum.at(best, now.pairs // width, _vector(summed[-1], len(now.pairs)))
    found = []
    for first, counts in zip(starts, summed, strict=True):
        now = block(first)
        measured = looked_up(stored, now, _vector(counts, len(now.pairs)), best, lengths)
        found.append(written(measured, "alignment_measures"))
    for done in (stored, parts, hashed, *summed):
        discard(done)
    same = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    sums = reduce(DataFrame.unionAll, found).groupBy("uid", *same).agg(*[F.sum(c).alias(c) for c in ("n_best", "count_sum")])
    return sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
