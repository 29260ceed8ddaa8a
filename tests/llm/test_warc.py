import base64
import hashlib
import random
import struct
import zlib

import pytest
import zstandard
from tidemark.llm import warc
from tidemark.session import new_path

SCHEMA = "page_id long, url string, html string"


def pages():
    rng = random.Random(3)
    words = ["tide", "mark", "<div class='x'>", "</div>", "é", "\r\n\r\n", "\x00", "WARC/1.1"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(400))) for _ in range(120)]
    rows = [(i, f"https://h{i % 5}.example/{i}", t) for i, t in enumerate(texts)]
    rows += [(200 + i, f"https://copy.example/{i}", texts[7]) for i in range(60)]
    rows += [(300, None, None), (301, "", ""), (302, "x\r\nY: z é", "b"), (303, "u", "b"), (None, "n", "b"), (None, None, None)]
    rows += [(303, "u", "b"), (303, "other", "b"), (400, "long", "long text " * 200_000)]
    return rows


def expected(rows, least=0):
    """(page_id, bytes, digest, type, refers_to), rows that are alike in id and payload in any order."""
    groups, out = {}, []
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    for data, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = max(ids, key=lambda i: -1 if i is None else i)
        done = False
        for i in ids:
            response = len(data) < least or (i == first and not done)
            done |= i == first
            out.append((i, len(data), digest, "response" if response else "revisit", None if response else first))
    return sorted(out, key=repr)


def results(df):
    kept = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in kept.collect()), key=repr)


@pytest.mark.parametrize("least", [0, 2])
def test_records_come_back(spark, least):
    rows = pages()
    assert results(warc.archived_pages(spark.createDataFrame(rows, SCHEMA).repartition(6), least=least)) == expected(rows, least)


def test_payloads_addresses_and_links(spark):
    path = new_path(spark, "warc")
    rows = pages()
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path)
    stored = warc.read_archives(spark, path).collect()
    held = {i: (t or "") for i, _, t in rows if i is not None}
    responses = {r.record_id: r for r in stored if r.record_type == "response"}
    assert len(responses) == len({t or "" for *_, t in rows}) and len({r.record_id for r in stored}) == len(rows)
    for r in responses.values():
        assert bytes(r.payload).decode() == held[r.row_id]
    assert {r.target_uri for r in stored if r.row_id == 302} == {"x%0D%0AY:%20z%20é"}
    assert {r.target_uri for r in stored if r.row_id == 300} == {"urn:unknown"}


def test_files_are_plain_frames(spark):
    """Any decoder reads the files: a dictionary frame first, then frames that it skips or that hold one record each."""
    path = new_path(spark, "warc")
    rows = [(i, f"u{i}", f"<html><body><p>page {i} of the same site</p></body></html>" * 5) for i in range(300)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    (data,) = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_MAGIC and size > 200
    trained = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(data, read_across_frames=True)
    text = reader.read(1 << 24)
    assert text.count(b"WARC/1.1\r\n") == 301 and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    kinds = [m for m, _, _ in warc.frames(memoryview(data))]
    assert kinds[0] == warc.DICTIONARY_MAGIC and kinds.count(warc.FRAME_MAGIC) == 301
    assert len(data) < len(text) // 3


def test_damage_is_reported():
    packed = zstandard.ZstdCompressor(write_checksum=True).compress(b"x" * 1000)
    assert [n for *_, n in warc.frames(memoryview(packed))] == [len(packed)]
    with pytest.raises(ValueError):
        list(warc.frames(memoryview(packed[:-1])))
    whole = warc.record(b"payload", 1, 2, "u", base64.b32encode(hashlib.sha1(b"payload").digest()).decode(), "1970-01-01T00:00:00Z", None)
    assert warc.parsed(whole)[1].endswith(b"payload")
    with pytest.raises(ValueError):
        warc.parsed(whole.replace(b"payload\r\n", b"paYload\r\n"))


@pytest.mark.parametrize("size", [0, 1, 100, 200_000, 3_000_000])
def test_frame_sizes(size):
    data = bytes(zlib.crc32(bytes([i % 251])) % 256 for i in range(1000)) * (size // 1000) + b"a" * (size % 1000)
    for checksum in (False, True):
        packed = zstandard.ZstdCompressor(write_checksum=checksum).compress(data)
        assert [(a, n) for _, a, n in warc.frames(memoryview(packed + packed))] == [(0, len(packed)), (len(packed), len(packed))]


def test_empty_table_and_clashing_names(spark):
    assert results(warc.archived_pages(spark.createDataFrame([], SCHEMA))) == []
    clashing = spark.createDataFrame([(1, "u", "t", 2, "a", "b", "c")], SCHEMA + ", HTML int, payload string, digest string, first string")
    assert results(warc.archived_pages(clashing)) == expected([(1, "u", "t")])
