"""Web archives in per-record Zstandard frames, with a dictionary in front of each file.

A file is a leading skippable frame that holds a dictionary built from records of that file, then one
frame for each WARC record, compressed by the dictionary. Payloads seen before are written as revisit
records. Files are written by Spark's own text writer, so they appear only when their task's commit
does, on any file system: the line separator given to it is an empty skippable frame, which readers of
Zstandard pass over. They keep the names that Spark gives them; the format shows in the first bytes.
"""

from __future__ import annotations

import base64
import hashlib
import io
import math
import struct
import sys
import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"

#: Payload to a file, the dictionary's size, and how much of a file's first records it is built from.
FILE_MB = 32.0
DICTIONARY_BYTES = 64 * 1024
TRAIN_BYTES = 2_000_000
LEVEL = 3
#: Equal payloads of at least so many bytes are written once.
MIN_REVISIT_BYTES = 0
DATE = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    key: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str = DATE
) -> bytes:
    """A WARC record: a response with its payload, or with ``refers_to`` a revisit without."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{ID_PREFIX}{urllib.parse.quote(key or '', safe='')}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest_of(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        safe = urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]")
        lines.append(f"WARC-Target-URI: {safe}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
        lines.append(f"WARC-Refers-To: <{ID_PREFIX}{urllib.parse.quote(refers_to, safe='')}>")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]):
    """A dictionary from whole records; of too few to train on, their bytes themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=256, d=8)
    except zstandard.ZstdError:
        raw = b"".join(records)[:DICTIONARY_BYTES]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def compressed(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one file."""
    import zstandard

    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= TRAIN_BYTES:
            break
    if not first:
        return
    dictionary = build_dictionary(first)
    data = dictionary.as_bytes()
    yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    while first:
        yield compressor.compress(first.pop(0))
    for record in records:
        yield compressor.compress(record)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _key(value: str | None) -> str | None:
    if value is None:
        return None
    return urllib.parse.unquote(value.strip("<>").removeprefix(ID_PREFIX)) or None


def records_in(file: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """Of each record its WARC fields, its HTTP fields and its payload."""
    import zstandard

    if not file:
        return
    magic, size = struct.unpack_from("<II", file)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame at the start of the file")
    dictionary = zstandard.ZstdCompressionDict(bytes(file[8 : 8 + size]))
    reader = io.BufferedReader(
        zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
            memoryview(file)[8 + size :], read_across_frames=True
        ),
        1 << 20,
    )
    while True:
        head = []
        while (line := reader.readline()) not in (b"\r\n", b""):
            head.append(line)
        if not head:
            return
        fields = _fields(b"".join(head).rstrip(b"\r\n"))
        block = reader.read(int(fields["content-length"]))
        if reader.read(4) != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
            raise ValueError("a record is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        yield fields, _fields(http), payload


def _payload(column: Column) -> Column:
    return F.encode(F.coalesce(column.cast("string"), F.lit("")), "UTF-8")


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    file_mb: float = FILE_MB,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """One record for each row of ``pages``, in files of about ``file_mb`` of payload below ``path``.

    Of the rows with equal payloads of ``min_revisit_bytes`` or more, the one with the largest key is
    a response and the others revisit it; repeated rows with that key are responses all. A null
    payload is empty, a null url is left out, a null key is written empty and always a response. No
    rows give a folder without records. Other columns are ignored.
    """
    body = _payload(F.col(payload))
    digests = stored(
        pages.select(
            F.col(key).alias("key"), F.sha1(body).alias("digest"), F.octet_length(body).alias("size")
        ),
        "digests",
    )
    mb = (digests.agg(F.sum("size")).first()[0] or 0) / 1e6
    files = max(1, math.ceil(mb / file_mb))
    first = (
        digests.filter((F.col("size") >= min_revisit_bytes) & F.col("key").isNotNull())
        .groupBy("digest")
        .agg(F.max("key").alias("first"), F.min("key").alias("last"))
        .filter("first != last")
        .select("digest", "first")
    )
    revisits = (
        digests.filter(F.col("size") >= min_revisit_bytes)
        .join(first, "digest")
        .filter("key != first")
        .select("key", "digest", "first")
        .distinct()
    )
    # A revisit's mark and its page meet in one shuffle, marks before pages.
    page_rows = pages.select(
        F.col(key).alias("key"),
        F.sha1(body).alias("digest"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(pages.schema[key].dataType).alias("first"),
        F.col(url).cast("string").alias("url"),
        body.alias("payload"),
    )
    marks = revisits.select(
        "key",
        "digest",
        F.lit(0).alias("kind"),
        "first",
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("payload"),
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        at, target = None, None
        for batch in batches:
            columns = [batch.column(c) for c in ("key", "digest", "kind", "first", "url", "payload")]
            for i in range(batch.num_rows):
                own, digest, kind, refers, address, data = (c[i].as_py() for c in columns)
                if kind == 0:
                    at, target = (own, digest), refers
                    continue
                if at != (own, digest):
                    at, target = (own, digest), None
                yield record_bytes(own, address, data, target)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for frame in compressed(records(batches)):
            held.append(frame)
            size += len(frame)
            if size > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])

    strings = [
        F.col(c).cast("string").alias(c) if c in ("key", "first") else F.col(c)
        for c in ("key", "digest", "kind", "first", "url", "payload")
    ]
    frames = (
        page_rows.unionByName(marks)
        .select(*strings)
        .repartition(files, "key", "digest")
        .sortWithinPartitions("key", "digest", "kind")
        .mapInArrow(write, "frame binary")
    )
    frames.select(F.col("frame").cast("string").alias("value")).write.text(path, lineSep=EMPTY_FRAME)


def read_archives(
    spark: SparkSession, path: str, key_type: str = "long", with_payload: bool = False
) -> DataFrame:
    """(key, url, record_type, payload_bytes, payload_digest, refers_to[, payload]) of each record.

    A response's length and digest are those of the payload as read; a digest that differs from the
    record's is an error. A revisit's are those that its headers state.
    """
    fields = [
        "key string",
        "url string",
        "record_type string",
        "payload_bytes long",
        "payload_digest string",
        "refers_to string",
        *(["payload binary"] if with_payload else []),
    ]
    names = [field.split()[0] for field in fields]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for file in batch.column("content"):
                rows, size = [], 0
                for warc, http, payload in records_in(file.as_py()):
                    digest = warc["warc-payload-digest"].removeprefix("sha1:")
                    length = int(http["content-length"])
                    if warc["warc-type"] == "response":
                        if digest_of(payload) != digest or len(payload) != length:
                            raise ValueError(f"payload of {warc['warc-record-id']} is damaged")
                    row = (
                        _key(warc["warc-record-id"]),
                        warc.get("warc-target-uri"),
                        warc["warc-type"],
                        length,
                        digest,
                        _key(warc.get("warc-refers-to")),
                    )
                    rows.append((*row, payload) if with_payload else row)
                    size += len(payload) if with_payload else 500
                    if size > 4_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    found = (
        spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, ", ".join(fields))
    )
    return found.withColumns(
        {name: F.col(name).cast(key_type) for name in ("key", "refers_to")}
    )
