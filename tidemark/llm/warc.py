"""WARC archives compressed record by record with a dictionary learned from the records.

A Zstandard dictionary is trained on a bounded sample and stands in a skippable frame
at the head of each archive; every record is a frame of its own, so one record can be
read without its neighbours. Each task writes one archive through Spark's own writer,
whose commit leaves nothing of failed or repeated tasks. That writer separates rows, so
an empty skippable frame, which every decoder passes over, follows each record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import pick
from tidemark.session import discard, new_path, written

#: Fixed values of the formats: magic numbers, the empty skippable frame, and the revisit profile.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\0\0\0\0"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The dictionary is trained on the heads of about so many records, and has so many bytes at most.
SAMPLE_ROWS = 1000
SAMPLE_BYTES = 8 << 10
DICTIONARY_BYTES = 64 << 10

#: Bytes of records that one batch of read records holds, or one longer record.
BATCH_BYTES = 8 << 20


def _urn(row_id: object, uid: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{row_id}/{uid}'.encode()).digest())}>"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(url: str | None) -> str:
    """The address with blanks and control characters escaped, so that it stays on its line."""
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "urn:unknown")


def record(payload: bytes, row_id: object, uid: int, url: str | None, digest: str, date: str, first: tuple | None) -> bytes:
    """One WARC record; with ``first``, the (row id, uid) of the response of equal payload, a revisit of it.

    The block of a revisit is the HTTP header alone, whose length is that of the whole payload.
    """
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {"WARC-Type": "revisit" if first else "response", "WARC-Record-ID": _urn(row_id, uid), "WARC-Date": date, "WARC-Target-URI": _uri(url)}
    if row_id is not None:
        fields["X-Row-ID"] = row_id
    if first:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _urn(*first)}
        if first[0] is not None:
            fields["X-Refers-To-Row-ID"] = first[0]
    else:
        block += payload
    fields |= {"WARC-Payload-Digest": f"sha1:{digest}", "WARC-Block-Digest": f"sha1:{_base32(hashlib.sha1(block).digest())}"}
    fields |= {"Content-Type": "application/http;msgtype=response", "Content-Length": len(block)}
    return _framed(fields, block)


def _framed(fields: dict[str, object], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return b"".join((b"WARC/1.1\r\n", head.encode(), b"\r\n", block, b"\r\n\r\n"))


def _information(date: str) -> bytes:
    block = b"software: tidemark\r\nformat: WARC File Format 1.1\r\n"
    fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": date}
    return _framed(fields | {"Content-Type": "application/warc-fields", "Content-Length": len(block)}, block)


def train(records: list[bytes]) -> bytes:
    """A dictionary for such records; empty where they are too few or too short to train one."""
    size = min(DICTIONARY_BYTES, sum(map(len, records)) // 8)
    try:
        return zstandard.train_dictionary(size, records, k=256, d=8).as_bytes() if len(records) > 7 and size >= 256 else b""
    except zstandard.ZstdError:
        return b""


def write_archives(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record per row into archives below ``path``, one for each task, named as Spark names files.

    Of rows with equal payloads of at least ``least`` bytes, the one with the largest id is a
    response and the others are revisits of it; shorter payloads are all responses. Among rows that
    also agree in the id, any one of them is the response; a null id comes before all others.
    A null payload is empty; a null address is written as ``urn:unknown``. ``date`` is that of all
    records. Other columns are ignored. An empty table gives an empty folder.
    """
    payload = F.encode(F.coalesce("payload", F.lit("")), "UTF-8")
    rows = pick(df, row_id=id_col, url=url_col, payload=payload_col)
    id_type = rows.schema["row_id"].dataType
    rows = rows.select("row_id", "url", payload.alias("payload"))
    stored = written(rows.select("*", F.sha1("payload").alias("digest"), F.monotonically_increasing_id().alias("uid")), "warc_rows")

    # rows by a bound on their hash, so that no task sends more than its share of the sample
    bound = SAMPLE_ROWS * (1 << 62) // max(1, stored.count()) * 2
    heads = stored.where(F.xxhash64("digest", "uid").bitwiseAND(F.lit((1 << 63) - 1)) < min(bound, (1 << 63) - 1))
    heads = heads.select("row_id", "uid", "url", "digest", F.substring("payload", 1, SAMPLE_BYTES).alias("payload")).collect()
    dictionary = train([record(bytes(r.payload), r.row_id, r.uid, r.url, _base32(bytes.fromhex(r.digest)), date, None) for r in heads])

    named = F.struct("row_id", "uid")
    firsts = stored.where(F.length("payload") >= least).groupBy("digest").agg(F.max(named).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1").select(F.col("digest").alias("of"), "first")
    marked = stored.join(firsts, F.col("digest") == F.col("of"), "left").select(
        "row_id", "uid", "url", "payload", "digest", F.when(F.col("first.uid") != F.col("uid"), F.col("first")).alias("first")
    )
    schema = T.StructType([T.StructField("frame", T.BinaryType())])

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=6, dict_data=trained, write_checksum=True)
        head = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        head += pack.compress(_information(date))
        for batch in batches:
            frames = [head] if head else []
            head = b""
            firsts = ((f["row_id"], f["uid"]) if f else None for f in batch.column("first").to_pylist())
            columns = (batch.column(c).to_pylist() for c in ("row_id", "uid", "url", "digest"))
            for data, row_id, uid, url, digest, first in zip(batch.column("payload"), *columns, firsts, strict=True):
                one = record(data.as_py(), row_id, uid, url, _base32(bytes.fromhex(digest)), date, first)
                frames.append(pack.compress(one))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=schema.names)

    if not isinstance(id_type, (T.IntegralType, T.StringType)):
        raise TypeError(f"{id_col} must be a whole number or a string")
    frames = marked.mapInArrow(compressed, schema).select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 0).option("compression", "none").text(path)
    discard(stored)


def frames(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """(magic, place, length) of every frame of an archive, from the sizes that its blocks state."""
    at = 0
    while at < len(data):
        (magic,) = struct.unpack_from("<I", data, at)
        end = at + 8
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            end += struct.unpack_from("<I", data, at + 4)[0]
        elif magic == FRAME_MAGIC:
            end, last = at + zstandard.frame_header_size(data[at : at + 18]), False
            while not last:
                word = int.from_bytes(data[end : end + 3], "little")
                last, kind = word & 1, word >> 1 & 3
                end += 3 + (1 if kind == 1 else word >> 3)
            end += 4 * (data[at + 4] >> 2 & 1)  # the checksum
        else:
            raise ValueError(f"no Zstandard frame at byte {at}")
        if end > len(data):
            raise ValueError(f"the frame at byte {at} is cut off")
        yield magic, at, end - at
        at = end


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """The fields, in lower case, and the block of one record; its length and block digest are verified."""
    head, rest = data.split(b"\r\n\r\n", 1)
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    block = rest[:-4]
    if version != "WARC/1.1" or rest[-4:] != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
        raise ValueError(f"not a whole WARC record: {head[:200]!r}")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{_base32(hashlib.sha1(block).digest())}":
        raise ValueError(f"the block of {fields['warc-record-id']} does not have its digest")
    return fields, block


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Every response and revisit of the archives below ``path``, decompressed and verified.

    (archive, offset, length, record_id, record_type, target_uri, row_id, refers_to, payload_digest,
    payload_bytes, payload): where its frame lies, what its fields say, and for a response the payload and
    the digest computed from it; a revisit has no payload, and digest and length from its fields.
    Damaged archives raise an error. An archive is read whole by one task, which bounds its useful size.
    """
    fields = "archive string, offset long, length long, record_id string, record_type string, target_uri string, row_id string, refers_to string"
    schema = f"{fields}, payload_digest string, payload_bytes long, payload binary"
    names = [f.split()[0] for f in schema.split(", ")]

    def rows(archive: str, data: memoryview) -> Iterator[tuple]:
        trained = None
        for magic, at, size in frames(data):
            if magic == DICTIONARY_MAGIC:
                trained = zstandard.ZstdCompressionDict(data[at + 8 : at + size].tobytes())
            if magic != FRAME_MAGIC:
                continue
            info, block = parsed(zstandard.ZstdDecompressor(dict_data=trained).decompress(data[at : at + size]))
            kind = info["warc-type"]
            if kind == "warcinfo":
                continue
            head, payload = block.split(b"\r\n\r\n", 1)
            stated = next(int(x[15:]) for x in head.decode().split("\r\n") if x.startswith("Content-Length:"))
            digest = info["warc-payload-digest"][5:]
            if kind == "response" and (stated, digest) != (len(payload), found := _base32(hashlib.sha1(payload).digest())):
                raise ValueError(f"the payload of {info['warc-record-id']} has {len(payload)} bytes and the digest {found}")
            yield (
                archive, at, size, info["warc-record-id"], kind, info.get("warc-target-uri"), info.get("x-row-id"), info.get("x-refers-to-row-id"),
                digest, stated, payload if kind == "response" else None,
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary()]
        for batch in batches:
            for archive, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                held, size = [], 0
                for one in rows(archive, memoryview(data.as_buffer())):
                    held.append(one)
                    size += len(one[-1] or b"") + 500
                    if size >= BATCH_BYTES:
                        yield _batch(held, names, types)
                        held, size = [], 0
                if held:
                    yield _batch(held, names, types)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInArrow(read, schema)
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("row_id", "refers_to")})


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def archived_pages(df: DataFrame, least: int = 0) -> DataFrame:
    """Archive all pages below the shared folder and describe every record as it is read back.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, archive, offset, length).
    """
    path = new_path(df.sparkSession, "warc")
    write_archives(df, path, least=least)
    kept = ["payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset", "length"]
    return read_archives(df.sparkSession, path).select(F.col("row_id").alias("page_id"), *kept)
