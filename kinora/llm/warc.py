"""WARC files with a Zstandard dictionary in a leading skippable frame.

A file is one skippable frame (magic 0x184D2A5D, 4-byte little-endian size, the
dictionary) followed by one Zstandard frame per record.  The dictionary is trained on
a bounded sample of the records to archive (``sample_pages``, at most ``SAMPLE_BYTES``
of each).  Of pages with equal payloads of at least ``min_revisit_bytes`` that with
the smallest page_id is a response record and the others are revisit records without a
payload; payloads are compared by their SHA-1 digest and length.

Cases: a null html is an empty payload, a null url becomes ``about:blank``; a null
page_id is never the smallest unless its group has no other; rows that repeat the
smallest page_id with the same payload are responses too; an empty table gives no
records; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.session import materialize, work_dir

SKIPPABLE = 0x184D2A5D
SAMPLE_BYTES = 32 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, size: int, digest: str, first, date: str) -> bytes:
    """One record; ``first`` is the page that a revisit refers to, or None."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if first is not None else 'response'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {quote(url or 'about:blank', safe=';/?:@&=+$,#%[]!*()~')}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response"]
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(first, digest)}", f"Refers-To-Page-Id: {first}"]
    return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def train_dictionary(pages: DataFrame, sample_pages: int, dictionary_bytes: int, date: str) -> bytes:
    """A dictionary from records of the ``sample_pages`` pages of smallest hashed id."""
    spark = pages.sparkSession
    ids = [r[0] for r in pages.select("page_id").where("page_id is not null").distinct()
           .orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages).collect()]
    if not ids:
        return b""
    chosen = F.broadcast(spark.createDataFrame([(i,) for i in ids], "page_id long"))
    rows = (pages.join(chosen, "page_id", "left_semi")
            .select("page_id", "url", F.substring(F.col("html"), 1, SAMPLE_BYTES).alias("html")).limit(sample_pages).collect())
    samples = [record(r.page_id, r.url, p := (r.html or "").encode(), len(p), _base32(hashlib.sha1(p).digest()), None, date)
               for r in rows]
    try:
        return zstandard.train_dictionary(dictionary_bytes, samples, level=3).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def with_revisits(pages: DataFrame, min_revisit_bytes: int) -> DataFrame:
    """page_id, url, html, size, sha1 and first: the page that a revisit refers to, else null.

    Digests shared by several pages are counted behind a partial aggregate and joined
    back; adaptive execution broadcasts that table where small and splits a hot digest
    otherwise.  A revisit's payload is dropped here."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"),
                        F.octet_length(html).cast("long").alias("size"), F.sha1(F.encode(html, "UTF-8")).alias("sha1"))
    shared = (rows.where(F.col("size") >= min_revisit_bytes).groupBy("sha1", "size")
              .agg(F.min("page_id").alias("smallest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(shared, ["sha1", "size"], "left")
    first = F.when(~F.col("smallest").eqNullSafe(F.col("page_id")), F.col("smallest"))
    return (joined.withColumn("first", first)
            .select("page_id", "url", F.when(F.col("first").isNull(), F.col("html")).alias("html"), "size", "sha1", "first"))


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0, sample_pages: int = 1000,
               dictionary_bytes: int = 64 << 10, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives under ``path``; returns their names and record counts."""
    spark = pages.sparkSession
    common.small_batches(spark)
    dictionary = train_dictionary(pages, sample_pages, dictionary_bytes, date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)
                                        if dictionary else None).compress
        batch = next(batches, None)
        if batch is None:
            return
        name, n = f"pages-{TaskContext.get().partitionId():06d}.warc.zst", 0

        def parts():
            nonlocal batch, n
            yield struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary
            while batch is not None:
                for r in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "size", "sha1", "first")), strict=True):
                    page_id, url, html, size, sha1, first = r
                    yield pack(record(page_id, url, (html or "").encode(), size, _base32(bytes.fromhex(sha1)), first, date))
                    n += 1
                batch = next(batches, None)

        size = common.write_file(f"{path}/{name}", parts())
        yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return materialize(with_revisits(pages, min_revisit_bytes).mapInArrow(write, "file string, records long, bytes long"), "warc-files")


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of one file, read in pieces."""
    with common.open_file(uri) as f:
        magic, size = struct.unpack("<II", f.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{uri}: no dictionary frame")
        dictionary = f.read(size)
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        rest = f.read(1 << 20)
        while rest:
            frame, out = unpack.decompressobj(), []
            while True:
                out.append(frame.decompress(rest))
                if frame.eof:
                    break
                if not (rest := f.read(1 << 20)):
                    raise ValueError(f"{uri}: cut within a record")
            rest = frame.unused_data or f.read(1 << 20)
            head, _, block = b"".join(out).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines[1:])
            yield fields, block[:int(fields["Content-Length"])]


def read_warc(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Per record of the archives: page_id, payload size and digest, record type and the
    page referred to.  A response's size and digest come from its payload."""
    common.small_batches(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                for fields, block in records(f"{path}/{name}"):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, first, page = fields["WARC-Type"], fields.get("Refers-To-Page-Id"), fields.get("Page-Id")
                    if kind == "response":
                        size, digest = len(payload), _base32(hashlib.sha1(payload).digest())
                    else:
                        size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r")[0])
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    rows.append((None if page is None else int(page), size, digest, kind, None if first is None else int(first)))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return files.select("file").repartition(max(1, files.count()), "file").mapInArrow(read, FIELDS)


def warc_archive(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages`` in the session's shared folder, then read the archives back."""
    path = work_dir(pages.sparkSession, "warc")
    return read_warc(pages.sparkSession, path, write_warc(pages, path, **options))
