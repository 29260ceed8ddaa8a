"""Hashes of all words of a batch of texts, from the bytes, without a Python string for a word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text to hash at a time: the work needs some fifty times as much memory.
HASHED_BYTES = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _table(letters_only: bool) -> np.ndarray:
    """What each byte counts as: 0 is left out, 1 is white space; A to Z count as a to z."""
    table = np.arange(256, dtype=np.uint64) + np.uint64(2)
    table[65:91] += np.uint64(32)
    if letters_only:
        signs = [b for b in range(128) if not chr(b).isalnum()]
        table[signs] = 0
    table[[9, 10, 11, 12, 13, 32]] = 1
    return table


_TABLES = {flag: _table(flag) for flag in (False, True)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all of them; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, factor in enumerate((_FACTOR, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def compacted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.LargeStringArray]:
    """The texts' bytes, their bounds in them from 0, and the texts as an array of its own; null texts are empty.

    String functions of a slice can return bounds that do not fit its bytes, so slices are copied first.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    size = int(bounds[-1] - bounds[0])
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if size else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    own = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw.tobytes()))
    return raw, bounds, own


def word_hashes(texts: pa.Array, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash, never 0, of each word of the texts in order, and the texts' bounds in them.

    Words are runs of other bytes than ASCII white space; A to Z count as a to z. With
    ``letters_only``, letters beyond ASCII are lowered too, ASCII signs and general
    punctuation are left out, and words of nothing else are no words. A null text has none.
    """
    raw, offsets, own = compacted(texts)
    if letters_only:
        raw, offsets, _ = compacted(pc.utf8_lower(own))
    value = _TABLES[letters_only][raw]
    if letters_only and len(raw):
        value[_signs(raw)] = 0
    # a white space after each text keeps words of neighbours apart
    value = np.insert(value, offsets[1:], np.uint64(1))
    ends_of_texts = offsets[1:] + np.arange(len(texts))  # places of those
    space = value == 1
    held = (value > 1)
    count = np.concatenate([[0], np.cumsum(held)])
    kept = value[held]
    forward, back = _powers(len(kept) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(kept * forward[: len(kept)])])
    cuts = count[:-1][space]  # kept bytes before each white space
    starts = np.concatenate([[0], cuts[:-1]]) if len(cuts) else cuts
    size = cuts - starts
    full = size > 0
    starts, cuts, size = starts[full], cuts[full], size[full]
    words = mixed((total[cuts] - total[starts]) * back[starts] + size.astype(np.uint64) * _M2)
    words[words == 0] = 1
    before = np.concatenate([[0], np.cumsum(full)])
    text_ends = before[np.cumsum(space)[ends_of_texts]] if len(texts) else np.zeros(0, np.int64)
    return words, np.concatenate([[0], text_ends]).astype(np.int64)


def _signs(raw: np.ndarray) -> np.ndarray:
    """Bytes of the UTF-8 signs U+0080 to U+00BF and U+2000 to U+207F."""
    two = np.flatnonzero(raw == 0xC2)
    three = np.flatnonzero(raw[:-1] == 0xE2) if len(raw) else two
    three = three[(raw[three + 1] == 0x80) | (raw[three + 1] == 0x81)]
    return np.concatenate([two, two + 1, three, three + 1, three + 2])
