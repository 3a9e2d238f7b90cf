import base64
import hashlib
import struct

import zstandard

from kinora.llm import common, warc
from kinora.session import work_dir

SCHEMA = "page_id long, url string, html string, payload_digest string"


def expected(rows, least):
    first = {}
    for page, _, html, _ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        refers = first.get(html or "") if len(payload) >= least else None
        refers = None if refers == page else refers
        out.append((page, len(payload), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


ROWS = [(5, "http://a/ü b\r\nX: y", "<p>é</p>", "x"), (3, None, "<p>é</p>", "x"), (9, "u", None, "x"), (2, "u", "", "x"),
        (None, "u", "<p>é</p>", "x"), (None, "u", "alone", "x"), (7, "u", "WARC/1.1\r\n\r\n" * 30_000, "x"), (11, "u", "one\r\n\r\ntwo", "x"),
        *[(100 + i, "u", "copy", "x") for i in range(50)]]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    for least in (0, 5, 10**6):
        got = warc.warc_archive(pages, min_revisit_bytes=least)
        assert sorted(map(tuple, got.collect()), key=str) == expected(ROWS, least)


def test_dictionary_frame_and_single_records(spark):
    rows = [(i, f"http://h/{i}", f"<html><body>common words of page {i % 13} {i}</body></html>", "") for i in range(600)]
    path = work_dir(spark, "test-warc")
    files = warc.write_warc(spark.createDataFrame(rows, SCHEMA), path)
    for r in files.collect():
        with common.open_file(f"{path}/{r.file}") as f:
            data = f.read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D and data[8:12] == struct.pack("<I", 0xEC30A437)
        one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size])).decompressobj()
        assert one.decompress(data[8 + size:]).startswith(b"WARC/1.1\r\n") and one.eof


def test_empty(spark):
    assert warc.warc_archive(spark.createDataFrame([], SCHEMA)).collect() == []
