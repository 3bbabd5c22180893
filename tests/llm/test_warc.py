import base64
import hashlib
import struct

import pytest

from tillroll.llm import warc
from tillroll.session import new_path


def test_round_trip_with_revisits(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    twins = pages.filter("page_id < 40").selectExpr("page_id + 10000 as page_id", "url", "html")
    odd = spark.createDataFrame(
        [(20001, None, None), (20002, "http://x/ y\r\nZ", ""), (20003, "http://x/é", "a\r\n\r\nWARC/1.1\r\n\r\n"),
         (20003, "http://x/é", "a\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "b"), (20004, "u", "ü" * 3_000_000)],
        "page_id long, url string, html string",
    )
    every = pages.unionByName(twins).unionByName(odd)
    path = new_path(spark, "archives")
    warc.write_archives(every, path, file_mb=0.1)
    got = warc.read_archives(spark, path, with_payload=True).collect()
    rows = every.collect()
    assert len(got) == len(rows)
    largest = {}
    for r in rows:
        if r.page_id is not None:
            largest[r.html or ""] = max(r.page_id, largest.get(r.html or "", -1))
    by_key = {r.key: r for r in got}
    for r in rows:
        own, body = by_key[r.page_id], (r.html or "").encode()
        assert own.payload_bytes == len(body)
        assert own.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        if r.page_id is None or largest[r.html or ""] == r.page_id:
            assert (own.record_type, own.refers_to, own.payload) == ("response", None, body)
        else:
            assert (own.record_type, own.refers_to) == ("revisit", largest[r.html or ""])


def test_small_payloads_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    path = new_path(spark, "archives")
    warc.write_archives(pages, path, min_revisit_bytes=2)
    assert {r.record_type for r in warc.read_archives(spark, path).collect()} == {"response"}


def test_nothing_and_damage(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = new_path(spark, "archives")
    warc.write_archives(pages, path)
    assert warc.read_archives(spark, path).collect() == []
    with pytest.raises(ValueError):
        list(warc.records_in(b"not an archive"))


def test_frames_stand_alone():
    import zstandard

    records = [warc.record_bytes(str(i), "http://x/", b"<p>the same words</p>" * 20, None) for i in range(300)]
    frames = list(warc.compressed(iter(records)))
    magic, size = struct.unpack_from("<II", frames[0])
    assert magic == warc.DICTIONARY_MAGIC and len(frames[0]) == 8 + size
    dictionary = zstandard.ZstdCompressionDict(frames[0][8:])
    for frame, record in zip(frames[1:], records, strict=True):
        assert zstandard.ZstdDecompressor(dict_data=dictionary).decompress(frame) == record
    joined = warc.EMPTY_FRAME.encode().join(frames)
    assert sum(1 for _ in warc.records_in(joined)) == 300
