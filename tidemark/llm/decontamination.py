"""Benchmark passages in documents, found although words were changed, added or left out.

Items and texts are sequences of units: words, and single characters of scripts that are written without
spaces. A CGK random walk copies a sequence to a
longer string, staying on a word or moving on by a random bit of (step, word), so that
few edits become few differing places. Items whose embeddings agree with that of an
item-sized window of a text in a few sampled places are candidates; several walks with several
samples each reach the recall. An exact edit distance decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import pick
from tidemark.llm.hashing import HASHED_BYTES, compacted, mixed, word_hashes
from tidemark.llm.tokens import chunks

#: Edits allowed per word of an item.
EDITS = 0.2
#: Items with fewer words must stand in a text as they are; with fewer than the second number they are no passages.
LEAST_WORDS, LEAST_EXACT = 8, 3
#: Bytes of item text that are searched for in one pass over the documents.
BLOCK_BYTES = 8 << 20
#: Walks, samples of each walk, and places in a sample.
WALKS, SAMPLES, PLACES = 6, 3, 2
#: Sizes of windows; items of 80 words or more are searched for in pieces of 40.
SIZES = (8, 10, 12, 15, 19, 24, 30, 37, 46, 57, 64)
LONG, PIECE = 80, 40

#: Characters that are units of their own, and signs that are none.
UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\p{Javanese}\p{Bopomofo}])"
WIDE_SIGNS = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"

_A = np.uint64(0x9E3779B97F4A7C15)


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each unit of the texts in order, and the texts' bounds in them; a null text has none."""
    raw, _, own = compacted(texts)
    # all of these characters begin with such a byte
    if (raw >= 0xE0).any() and pc.any(pc.match_substring_regex(own, f"{UNSPACED}|{WIDE_SIGNS}")).as_py():
        own = pc.replace_substring_regex(pc.replace_substring_regex(own, WIDE_SIGNS, " "), UNSPACED, r" \1 ")
    return word_hashes(own, letters_only=True)


def embedded(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, walk: int, steps: np.ndarray) -> np.ndarray:
    """The CGK embedding of the sequences words[start:end], at the given rising steps; 0 stands for no word."""
    at, out = starts.copy(), np.zeros((len(starts), len(steps)), np.uint64)
    keep = 0
    padded = np.append(words, np.uint64(0))
    for j in range(int(steps[-1]) + 1):
        word = padded[np.where(at < ends, at, len(words))]
        if j == steps[keep]:
            out[:, keep] = word
            keep += 1
        salt = np.uint64((walk * 100_003 + j + 1) * int(_A) % (1 << 64))
        at += (mixed(word + salt) & np.uint64(1)).astype(np.int64)
    return out


def closest(item: np.ndarray, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The fewest edits between ``item`` and any run of words in each text[start:end], and where such a run ends (exclusive, earliest)."""
    width = int((ends - starts).max()) if len(starts) else 0
    places = starts[:, None] + np.arange(width)
    words = np.where(places < ends[:, None], text[np.minimum(places, max(len(text) - 1, 0))] if len(text) else 0, np.uint64(0))
    row = np.zeros((len(starts), width + 1), np.int32)
    ramp = np.arange(width + 1, dtype=np.int32)
    for i, word in enumerate(item):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (words != word))
        row = np.minimum.accumulate(new - ramp, axis=1) + ramp
    row = np.where(np.arange(width + 1) <= (ends - starts)[:, None], row, np.int32(1 << 30))
    best = row.argmin(axis=1)
    return row[np.arange(len(starts)), best], starts + best


@dataclass
class Group:
    """Parts of items that are searched for with windows of one size."""

    size: int
    edits: int
    items: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray  # of the parts, in the block's words
    ends: np.ndarray
    pairs: np.ndarray  # which hashes of neighbouring words occur in the parts
    steps: np.ndarray  # for each walk, its sampled steps
    order: np.ndarray  # for each walk, which of them make up a sample
    tables: list[tuple[np.ndarray, np.ndarray]]  # for each sample: sorted keys, and the parts they belong to


class Block:
    """The searched items of one pass."""

    def __init__(self, texts: list[str | None], seed: int = 5):
        self.words, bounds = units(pa.array(texts, pa.string()))
        self.starts, self.ends = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
        lengths = self.ends - self.starts
        self.edits = np.where(lengths < LEAST_WORDS, 0, np.floor(EDITS * lengths)).astype(np.int64)
        self.short = {}  # by length: sorted keys, and the items they belong to
        for n in range(LEAST_EXACT, LEAST_WORDS):
            if len(own := np.flatnonzero(lengths == n)):
                keys = self.run_keys(self.words, self.starts[own], n)
                by = np.argsort(keys, kind="stable")
                self.short[n] = keys[by], own[by]
        self.bits = 22
        parts: dict[int, list[tuple[int, int, int]]] = {}
        for item, (a, b) in enumerate(zip(self.starts, self.ends, strict=True)):
            n = int(b - a)
            if n < LEAST_WORDS:
                continue
            if n >= LONG:
                for k in range(n // PIECE):
                    parts.setdefault(PIECE, []).append((item, k * PIECE, int(self.edits[item]) // (n // PIECE)))
            else:
                parts.setdefault(max(s for s in SIZES if s <= n), []).append((item, 0, int(self.edits[item])))
        random = np.random.RandomState(seed)
        self.groups = []
        for size, rows in sorted(parts.items()):
            item, offset, edits = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            starts = self.starts[item] + offset
            ends = np.minimum(starts + size + size // 4, self.ends[item])
            reach = size + size // 2
            steps = np.stack([np.sort(random.choice(reach, SAMPLES * PLACES, replace=False)) for _ in range(WALKS)])
            order = np.stack([random.permutation(SAMPLES * PLACES).reshape(SAMPLES, PLACES) for _ in range(WALKS)])
            pairs = np.zeros(1 << self.bits, bool)
            for a, b in zip(starts, ends, strict=True):
                pairs[self.pair_keys(self.words[a:b])] = True
            group = Group(size, int(edits.max()), item, offset, starts, ends, pairs, steps, order, [])
            for walk in range(WALKS):
                for key in self.keys(group, walk, embedded(self.words, starts, ends, walk, steps[walk])):
                    by = np.argsort(key, kind="stable")
                    group.tables.append((key[by], by))
            self.groups.append(group)

    @staticmethod
    def run_keys(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        """A hash of the n units from each start."""
        key = np.full(len(starts), n, np.uint64)
        for i in range(n):
            key = mixed(key * _A + words[starts + i])
        return key

    def exact(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(text, item, 0, end of the passage in the text) of every place that has a short item."""
        found = [np.zeros((0, 4), np.int64)]
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for n, (table, items) in self.short.items():
            starts = np.flatnonzero(np.arange(len(words)) + n <= bounds[1:][text_of])
            keys = self.run_keys(words, starts, n)
            a = np.searchsorted(table, keys)
            times = np.searchsorted(table, keys, "right") - a
            which = np.repeat(np.arange(len(starts)), times)
            item = items[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - a, times)]
            same = np.ones(len(which), bool)
            for i in range(n):
                same &= words[starts[which] + i] == self.words[self.starts[item] + i]
            own = starts[which[same]]
            found.append(np.stack([text_of[own], item[same], np.zeros(len(own), np.int64), own + n - bounds[text_of[own]]], axis=1))
        return np.concatenate(found)

    def pair_keys(self, words: np.ndarray) -> np.ndarray:
        return (mixed(words[:-1] * _A + words[1:]) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def keys(group: Group, walk: int, embedding: np.ndarray) -> list[np.ndarray]:
        out = []
        for places in group.order[walk]:
            key = np.zeros(len(embedding), np.uint64)
            for p in places:
                key = mixed(key * _A + embedding[:, p])
            out.append(key)
        return out

    @staticmethod
    def windows(pairs: np.ndarray, text_end: np.ndarray, group: Group) -> np.ndarray:
        """Starts of windows that keep enough of the parts' word pairs to be within the group's edits.

        Each edit destroys two of a part's pairs at most, so none of the true windows is lost.
        """
        total = np.concatenate([[0], np.cumsum(group.pairs[pairs], dtype=np.int32), [0]])
        total[-1] = total[-2]
        starts = np.arange(len(text_end))
        last = np.minimum(starts + group.size + group.edits, text_end) - 1
        need = max(1, group.size - 1 - 2 * group.edits)
        return np.flatnonzero(total[last] - total[:-1][: len(starts)] >= need)

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct (item, place its start should have, text) found by any sample."""
        if len(words) < 2:
            return np.zeros((0, 3), np.int64)
        text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        text_end = np.repeat(bounds[1:], np.diff(bounds))
        pairs, found = self.pair_keys(words), []
        for group in self.groups:
            starts = self.windows(pairs, text_end, group)
            if not len(starts):
                continue
            ends = bounds[1:][text_of[starts]].astype(np.int64)
            for walk in range(WALKS):
                keys = self.keys(group, walk, embedded(words, starts, ends, walk, group.steps[walk]))
                for key, (table, part) in zip(keys, group.tables[walk * SAMPLES : (walk + 1) * SAMPLES], strict=True):
                    a, b = np.searchsorted(table, key), np.searchsorted(table, key, "right")
                    n = b - a
                    which = np.repeat(np.arange(len(starts)), n)
                    p = part[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - a, n)]
                    found.append(np.unique(np.stack([group.items[p], starts[which] - group.offsets[p], text_of[starts[which]]], axis=1), axis=0))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def hits(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """(text, item, edits, end of the passage in the text): each item's best passage in each text, if close enough."""
        found = [self.exact(words, bounds)]
        rows = self.candidates(words, bounds)
        for item in np.unique(rows[:, 0]):
            _, place, text = rows[rows[:, 0] == item].T
            n, k = int(self.ends[item] - self.starts[item]), int(self.edits[item])
            # neighbouring places share a stretch of text, which is compared once
            new = np.ones(len(place), bool)
            order = np.lexsort((place, text))
            place, text = place[order], text[order]
            new[1:] = (text[1:] != text[:-1]) | (place[1:] - place[:-1] > k + 1)
            first, last = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(new)) - 1
            text = text[first]
            a = np.maximum(place[first] - k, bounds[text])
            b = np.minimum(place[last] + n + 2 * k, bounds[text + 1])
            for cut in range(0, len(first), 20_000):
                part = slice(cut, cut + 20_000)
                edits, end = closest(self.words[self.starts[item] : self.ends[item]], words, a[part], b[part])
                good = edits <= k
                own = text[part][good]
                found.append(np.stack([own, np.full(good.sum(), item), edits[good], end[good] - bounds[own]], axis=1))
        rows = np.concatenate(found)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
        return rows[new]


def blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The items' (id, text) rows in blocks of about BLOCK_BYTES of text, dealt by a hash."""
    own = pick(items, item_id=id_col, text=text_col).where("text IS NOT NULL")
    size = own.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    count = -(-size // BLOCK_BYTES)
    for k in range(count):
        yield own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).orderBy("item_id", "text").collect()


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(doc_id, item_id, edits, item_words, end_word): each document that holds an item, with the item's best passage.

    A document holds an item of n words if some run of its words can be made the item by
    at most EDITS * n insertions, deletions or replacements of words, or, where n is below
    LEAST_WORDS, if it holds the item as it is. Words are compared without case and signs; each
    character of a script without spaces counts as a word. The documents are read once for each
    block of items and are not shuffled. Null and empty texts hold nothing, and items of fewer
    than LEAST_EXACT words are not searched for. Repeated rows are each found; other columns are ignored.
    """
    own = pick(docs, doc_id=id_col, text=text_col)
    item_type = items.schema.fields[items.columns.index(item_id_col)].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", own.schema["doc_id"].dataType),
            T.StructField("item_id", item_type),
            T.StructField("edits", T.IntegerType()),
            T.StructField("item_words", T.IntegerType()),
            T.StructField("end_word", T.LongType()),
        ]
    )
    found = None
    for rows in blocks(items, item_id_col, item_text_col):
        ids, texts = [r.item_id for r in rows], [r.text for r in rows]

        def search(batches: Iterator[pa.RecordBatch], ids=ids, texts=texts) -> Iterator[pa.RecordBatch]:
            block = Block(texts)
            for batch in batches:
                names = pa.array(ids)
                for part in chunks(batch, "text", HASHED_BYTES):
                    words, bounds = units(part.column("text"))
                    hits = block.hits(words, bounds)
                    if len(hits):
                        item = hits[:, 1]
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column("doc_id").take(pa.array(hits[:, 0])),
                                names.take(pa.array(item)),
                                pa.array(hits[:, 2].astype(np.int32)),
                                pa.array((block.ends - block.starts)[item].astype(np.int32)),
                                pa.array(hits[:, 3]),
                            ],
                            names=schema.names,
                        )

        part = own.mapInArrow(search, schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns and clean rows are kept.

    Each block of items is a pass of its own over what the ones before have left.
    """
    place = docs.columns.index(text_col)
    left = docs.toDF(*(f"_c{i}" for i in range(len(docs.columns))))
    schema = left.schema
    for rows in blocks(items, item_text_col, item_text_col):
        texts = [r.text for r in rows]

        def search(batches: Iterator[pa.RecordBatch], texts=texts) -> Iterator[pa.RecordBatch]:
            block = Block(texts)
            for batch in batches:
                for part in chunks(batch, f"_c{place}", HASHED_BYTES):
                    clean = np.ones(part.num_rows, bool)
                    clean[block.hits(*units(part.column(place)))[:, 0]] = False
                    yield part.filter(pa.array(clean))

        left = left.mapInArrow(search, schema)
    return left.toDF(*docs.columns)
