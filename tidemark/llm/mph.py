"""Minimal perfect hash functions of sets of 64-bit keys, by levels of bits.

At each level the keys left are hashed to bits; a bit that one key alone claims is set
and is that key's, and the others go on to the next level. A key's index is the number
of set bits before its own, so n keys get 0 to n - 1 with about five bits a key.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.hashing import mixed

#: Bits of a level for each key that is left; levels at most, which distinct keys never need.
BITS_PER_KEY = 2
MOST_LEVELS = 64

_STEP = 0x9E3779B97F4A7C15


def spread(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys.astype(np.uint64) + np.uint64((level + 1) * _STEP % (1 << 64)))


class PerfectHash:
    """The functions of several shards side by side: bits, and the set bits before each word of them."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray, first: np.ndarray):
        """``sizes``: words by (shard, level), 0 beyond a shard's last; ``words`` in that order; ``first``: keys before each shard."""
        self.sizes, self.words = sizes.astype(np.uint64), words
        before = np.cumsum(sizes) - sizes.reshape(-1)
        self.starts = before.reshape(sizes.shape).astype(np.uint64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.cumsum(ones) - ones  # the shards' keys follow one another, and so do their bits
        self.first = first

    @classmethod
    def joined(cls, shards: list[tuple[np.ndarray, np.ndarray]]) -> PerfectHash:
        """Of (sizes, words) of single shards."""
        table = np.zeros((len(shards), max([len(s) for s, _ in shards], default=0)), np.int64)
        for i, (sizes, _) in enumerate(shards):
            table[i, : len(sizes)] = sizes
        words = np.concatenate([w for _, w in shards]) if shards else np.zeros(0, np.uint64)
        return cls(table, words, np.cumsum([0] + [int(np.bitwise_count(w).sum()) for _, w in shards]))

    def index(self, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Each key's index over all shards, or -1 where no bit is set for it; a strange key may get any index."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[shard[left], level]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            bit = spread(keys[left], level) % (size * np.uint64(64))
            word = (self.starts[shard[left], level] + (bit >> np.uint64(6))).astype(np.int64)
            mask = np.uint64(1) << (bit & np.uint64(63))
            hit = self.words[word] & mask != 0
            word, mask = word[hit], mask[hit]
            out[left[hit]] = self.ranks[word] + np.bitwise_count(self.words[word] & (mask - np.uint64(1)))
            left = left[~hit]
        return out


def built(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words of each level, the words) of one shard of distinct keys."""
    left, sizes, words = keys.astype(np.uint64), [], []
    while len(left):
        if len(sizes) == MOST_LEVELS:
            raise ValueError("keys repeat")
        size = -(-len(left) * BITS_PER_KEY // 64)
        bit = (spread(left, len(sizes)) % np.uint64(size * 64)).astype(np.int64)
        alone = np.bincount(bit, minlength=size * 64) == 1
        words.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
        sizes.append(size)
        left = left[~alone[bit]]
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64)
