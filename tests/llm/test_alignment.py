import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import CLASH_VALUES, CLASHING, SCHEMA, awkward
from tidemark.llm import alignment, mph

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_force(texts):
    """Every document's measures, pair by pair, from the libraries' own tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    one.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    held = []
    for text in texts:
        a, b, links, groups = [], [], [], []
        if text:
            a = one.encode(" " + text, add_special_tokens=False).ids
            b = two.encode(text)
            a_bytes = [bytes(alphabet[c] for c in one.id_to_token(i)) for i in a]
            pieces = [two.id_to_piece(i) for i in b]
            b_bytes = [bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
            if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
                a, b = [], []
            else:
                i = j = at = a_at = b_at = 0
                group = ([], [])
                while i < len(a):
                    links.append((a[i], b[j]))
                    a_stop, b_stop = a_at + len(a_bytes[i]), b_at + len(b_bytes[j])
                    at = min(a_stop, b_stop)
                    if a_stop == at:
                        group[0].append(a[i])
                        i, a_at = i + 1, at
                    if b_stop == at:
                        group[1].append(b[j])
                        j, b_at = j + 1, at
                    if a_stop == b_stop:
                        groups.append(group)
                        group = ([], [])
        held.append((a, b, links, groups))
    count = Counter(p for _, _, links, _ in held for p in set(links))
    best = Counter()
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for a, b, links, groups in held:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        top = sum(count[p] == best[p[0]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(groups), len(links), top, sum(count[p] for p in links), digest))
    return out


EXTRA = [
    "The <|endoftext|> a <s> <unk> <0x41> ▁x",
    "  two  spaces\n\nand\ttabs \x00 \x7f",
    "ﬁ ½ Å é 日本語 \U0001f600\U0001f468‍\U0001f469",
    "trailing   ",
    "1234567890" * 3 + " it's we'll THEY'VE",
]


def rows():
    return [*awkward(), *((100 + i, t, "en", "s", 1) for i, t in enumerate(EXTRA))]


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def expected(rows):
    return sorted(((r[0], *m) for r, m in zip(rows, brute_force([r[1] for r in rows]), strict=True)), key=repr)


def test_equals_brute_force(spark):
    data = rows()
    assert results(alignment.aligned_documents(spark.createDataFrame(data, SCHEMA), BYTE, PIECE)) == expected(data)


def test_many_blocks_and_rounds(spark, monkeypatch):
    """Several shards, blocks and rounds of the tree give the same."""
    for name, value in (("SHARD_PAIRS", 64), ("BLOCK_PAIRS", 256), ("PIECE", 32), ("FAN_IN", 2), ("HELD_PAIRS", 100), ("TEXT_BYTES", 500), ("ID_BYTES", 500)):
        monkeypatch.setattr(alignment, name, value)
    data = rows()[:20] + rows()[-5:]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert results(alignment.aligned_documents(df, BYTE, PIECE)) == expected(data)


def test_empty_table_and_clashing_names(spark):
    assert alignment.aligned_documents(spark.createDataFrame([], SCHEMA), BYTE, PIECE).collect() == []
    data = rows()[:8]
    clashing = spark.createDataFrame([(*r, *CLASH_VALUES) for r in data], CLASHING)
    assert results(alignment.aligned_documents(clashing, BYTE, PIECE)) == expected(data)


@pytest.mark.parametrize("text", [" " * 300_000, "a" * 300_000, "\n" * 100_000 + "x", "日" * 50_000])
def test_long_runs(text):
    both = alignment.WordPairs(alignment.ByteTokenizer(BYTE), alignment.PieceTokenizer(PIECE))
    raw = (" " + text).encode()
    for side, found in zip((both.first, both.second), both.encode(pa.array([text, None, ""])), strict=True):
        ids = np.frombuffer(found[0].as_py(), alignment.ID)
        assert side.bytes.of(ids).tobytes() == raw and found[1].as_py() == found[2].as_py() == b""


def test_words_apart_give_the_ids_of_whole_texts():
    import sentencepiece
    from tokenizers import Tokenizer

    rng = random.Random(2)
    signs = [" ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2028", "▁", "a", "the", "Wort", "été", "'s", "'", ".", ",", "12", "日本", "\x1c", "\x85", "😀", "İ", "x́"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(4000)]
    one, two = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    one.encode_special_tokens = True
    both = alignment.WordPairs(alignment.ByteTokenizer(BYTE), alignment.PieceTokenizer(PIECE))
    assert both.apart
    lost = 0
    for at in (0, 1000, 2000, 3000):
        part = texts[at : at + 1000]
        a, b = both.encode(pa.array(part))
        for text, x, y in zip(part, a.to_pylist(), b.to_pylist(), strict=True):
            if x or y:
                assert np.frombuffer(x, alignment.ID).tolist() == one.encode(" " + text, add_special_tokens=False).ids
                assert np.frombuffer(y, alignment.ID).tolist() == two.encode(text)
            else:
                lost += 1
                assert both.second.bytes.of(np.array(two.encode(text))).tobytes() != (" " + text).encode()
    assert lost < 4000


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 40_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 31, 2 * n))[:n]
    half = len(keys) // 2
    shards = np.arange(len(keys)) % 2 if n else keys
    parts = [mph.built(keys[shards == s]) for s in (0, 1)]
    own = mph.PerfectHash.joined(parts)
    assert sorted(own.index(keys, shards)) == list(range(len(keys)))
    if half:
        assert len(own.words) * 64 < 6 * len(keys) + 1000
