"""Byte-pair merges of many words at a time.

The words of a batch go through the merges of a tokenizer's model side by side: in each
round, every word merges its leftmost pair of the lowest rank, as the model does word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_NONE = np.int64((1 << 62) - 1)


def _byte_names() -> list[str]:
    """The characters that stand for the bytes in a byte-level vocabulary: printable ones themselves, others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, spare = [], 256
    for b in range(256):
        names.append(chr(b if b in shown else spare))
        spare += b not in shown
    return names


class Merges:
    """The merges of a byte-level model with a mark at word ends, as tables."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], mark: str):
        names = _byte_names()
        self.inner = np.array([vocabulary[n] for n in names], np.int64)
        self.last = np.array([vocabulary[n + mark] for n in names], np.int64)
        self.width = max(vocabulary.values()) + 1
        pairs = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in merges], np.int64)
        self.order = np.argsort(pairs, kind="stable")
        self.pairs = np.append(pairs[self.order], _NONE)
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int64)

    def _keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and place of each pair in one number, or _NONE."""
        pair = left * self.width + right
        found = np.searchsorted(self.pairs, pair)
        good = self.pairs[found] == pair
        keys = np.full(len(pair), _NONE, np.int64)
        keys[good] = self.order[found[good]] << 32 | at[good]
        return keys

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, which are not empty, in a row, and how many each has."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pa.array(words, pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[: len(words) + 1]
        raw = np.frombuffer(texts.buffers()[2], np.uint8)[: bounds[-1]]
        starts, size = bounds[:-1], len(raw)
        sign = self.inner[raw]
        sign[bounds[1:] - 1] = self.last[raw[bounds[1:] - 1]]
        place = np.arange(size)
        ends = np.repeat(bounds[1:], np.diff(bounds))
        following, previous = place + 1, place - 1
        key = np.full(size, _NONE, np.int64)
        inside = np.flatnonzero(place + 1 < ends)
        key[inside] = self._keys(sign[inside], sign[inside + 1], inside)
        active = starts
        while len(active):
            best = np.minimum.reduceat(key, active)
            going = best < _NONE
            active, best = active[going], best[going]
            i = best & np.int64(0xFFFFFFFF)
            j = following[i]
            sign[i] = self.made[best >> 32]
            sign[j], key[j], key[i] = -1, _NONE, _NONE
            after = following[j]
            following[i] = after
            has = after < ends[i]
            a, b = i[has], after[has]
            previous[b] = a
            key[a] = self._keys(sign[a], sign[b], a)
            before = previous[i]
            has = before >= active
            a, b = before[has], i[has]
            key[a] = self._keys(sign[a], sign[b], a)
        alive = sign >= 0
        return sign[alive].astype(np.uint32), np.add.reduceat(alive, starts, dtype=np.int64)
