"""Token ids of whole texts, in batches, by a tokenizer file that the caller names."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import pick
from tidemark.llm.hashing import compacted
from tidemark.llm.merges import Merges

#: Bytes of text that are encoded at a time; one longer text is encoded alone.
CHUNK_BYTES = 3 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _signs_apart(texts: pa.Array) -> pa.Array:
    """The texts with a space between a last letter and the point or comma that ends a word.

    Such a sign is encoded by itself anyway, and the words before it become fewer.
    """
    raw, offsets, texts = compacted(texts)
    if not len(raw):
        return texts
    sign = (raw == 46) | (raw == 44)
    sign[1:] &= _LETTER[raw[:-1]]
    sign[0] = False
    last = np.zeros(len(raw) + 1, bool)
    last[:-1] = _BLANK[raw]
    last[offsets] = True  # the next text begins, or all end
    first = np.zeros(len(raw) + 1, bool)
    first[offsets] = True
    at = np.flatnonzero(sign & last[1:] & ~first[:-1])
    new = np.insert(raw, at, 32)
    moved = offsets + np.searchsorted(at, offsets)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(moved.astype(np.int64)), pa.py_buffer(new))


class WordEncoder:
    """Ids of texts under a tokenizer that drops white space and encodes words apart.

    Text is cut at ASCII white space, and each distinct word of a batch is encoded once.
    Where the tokenizer's model allows it, words of Latin letters are merged side by side.
    """

    def __init__(self, path: str, closing: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.closing = closing
        about = json.loads(self.tokenizer.to_str())
        model = about["model"]
        kinds = [x["type"] for x in (about["pre_tokenizer"] or {}).get("pretokenizers", [])]
        lowered = [x["type"] for x in (about["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        usual = model["type"] == "BPE" and model.get("end_of_word_suffix") and not model["dropout"] and not model["ignore_merges"]
        self.merges = None
        if usual and lowered and kinds == ["Split", "ByteLevel"]:
            self.merges = Merges(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"])

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids in a row, and how many each has."""
        # letters up to U+017F are composed and have simple lower cases, but for U+0130
        plain = np.fromiter((w.isalpha() and max(w) <= "\u017f" and "\u0130" not in w for w in words), bool, len(words))
        plain &= self.merges is not None
        ids, sizes = self.merges.encode([w.lower() for w, p in zip(words, plain, strict=True) if p]) if plain.any() else (np.zeros(0, np.uint32), 0)
        found = [e.ids for e in self.tokenizer.encode_batch([w for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False)]
        size = np.zeros(len(words), np.int64)
        size[plain] = sizes
        size[~plain] = [len(f) for f in found]
        start = np.zeros(len(words), np.int64)
        start[plain] = np.cumsum(size[plain]) - size[plain]
        start[~plain] = len(ids) + np.cumsum(size[~plain]) - size[~plain]
        ids = np.concatenate([ids, np.fromiter((i for f in found for i in f), np.uint32)])
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return ids[at], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text's closed, and the texts' bounds in them."""
        texts = compacted(texts)[2]
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # else a special token could arise
            texts = pc.ascii_lower(texts)
        words = pc.ascii_split_whitespace(_signs_apart(texts))
        bounds = words.offsets.to_numpy()
        flat = words.flatten().dictionary_encode()
        ids, size = self._of_words(flat.dictionary.to_pylist())
        ids, size = np.append(ids, np.uint32(self.closing)), np.append(size, 1)
        start = np.cumsum(size) - size
        code = np.insert(flat.indices.to_numpy(zero_copy_only=False), bounds[1:] - bounds[0], len(size) - 1)
        length = size[code]
        ends = np.cumsum(length)
        at = np.repeat((start[code] - ends + length).astype(np.int32), length)
        at += np.arange(len(at), dtype=np.int32)
        last = bounds[1:] - bounds[0] + np.arange(len(texts))
        return ids[at], np.concatenate([[0], ends[last]]).astype(np.int64)


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, closing: int) -> WordEncoder:
    """This worker's encoder; it is loaded once."""
    if (path, closing) not in _ENCODERS:
        _ENCODERS[path, closing] = WordEncoder(path, closing)
    return _ENCODERS[path, closing]


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most if len(sizes) else sizes
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(sizes)]]).astype(int)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # a worker lives on, for other tasks


def cut(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each piece's text, its place in all ids and its length: texts cut into runs of at most ``length`` ids."""
    sizes = np.diff(bounds)
    count = -(-sizes // length)
    text = np.repeat(np.arange(len(sizes)), count)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = bounds[:-1][text] + piece * length
    return text, start, np.minimum(bounds[1:][text] - start, length)


def token_pieces(df: DataFrame, tokenizer: str, length: int, closing: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every text's ids and the closing one, cut into pieces.

    ``tokenizer`` is the path of a tokenizer that drops white space. A null text has
    the closing id only. Rows that repeat are cut each for itself; other columns are
    ignored.
    """
    docs = pick(df, doc_id=id_col, text=text_col)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, closing)
        for batch in batches:
            for part in chunks(batch, "text"):
                ids, bounds = own.encode(part.column("text"))
                text, at, size = cut(bounds, length)
                ids = np.ascontiguousarray(ids, "<u4")
                crc = np.fromiter((zlib.crc32(ids[a : a + n]) for a, n in zip(at, size, strict=True)), np.int64, len(at))
                start = at - bounds[:-1][text]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(text)), pa.array((start // length).astype(np.int32)), pa.array(start), pa.array(size), pa.array(crc)],
                    names=schema.names,
                )

    return docs.mapInArrow(cut_up, schema)
