"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import posixpath
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are hashed in runs of about this many bytes, which bounds a worker's arrays.
RUN_BYTES = 1 << 20
#: Rows of one Arrow batch; documents are long, so far fewer than Spark's default.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of long texts small, unless the session names another size."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def extended(df: DataFrame, run, **added: str) -> DataFrame:
    """``df`` with more columns, made by ``run(name)``: a function over its Arrow batches
    that gets the batch's own name of a column by ``name(column)`` and yields all columns
    and the added ones in order.  Columns may have any name."""
    names = df.columns
    inner = [f"c{i}" for i in range(len(names))]
    own = dict(zip(names, inner, strict=True))
    kinds = T.StructType([*(T.StructField(c, f.dataType) for c, f in zip(inner, df.schema.fields, strict=True)),
                          *(T.StructField(f"a{i}", T._parse_datatype_string(t)) for i, t in enumerate(added.values()))])
    out = df.toDF(*inner).mapInArrow(run(own.__getitem__), kinds)
    return out.select(*[F.col(c).alias(n) for n, c in own.items()], *[F.col(f"a{i}").alias(n) for i, n in enumerate(added)])


def with_columns(batch: pa.RecordBatch, *more: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *(f"a{i}" for i in range(len(more)))])


_CLAIMED: list = [None, None]


def claim(name: str | None, clear=None) -> None:
    """Workers outlive tasks: an operator that keeps words in one says so here, and the
    next operator that starts in the worker clears what the one before kept."""
    if _CLAIMED[0] != name:
        if _CLAIMED[1] is not None:
            _CLAIMED[1]()
            release()
        _CLAIMED[:] = [name, clear]


def release() -> None:
    """Give what this worker has freed back to the system, as far as its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run):
    """``run`` over Arrow batches, which ends with ``release``: workers wait for further
    tasks beside those at work, and what they hold counts for the executor meanwhile."""
    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()
    return whole


# -- files that tasks write and read -------------------------------------------
def filesystem(uri: str):
    """(pyarrow file system, path) of a folder that all executors share."""
    from pyarrow import fs
    if not urlparse(uri).scheme:
        uri = "file://" + uri
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, parts) -> int:
    """Write byte strings to ``uri`` under a private name, then rename: a repeated
    or speculative task leaves one whole file.  Returns the size."""
    import uuid
    f, path = filesystem(uri)
    f.create_dir(posixpath.dirname(path), recursive=True)
    tmp, size = f"{path}.{uuid.uuid4().hex[:8]}.tmp", 0
    with f.open_output_stream(tmp) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    f.move(tmp, path)
    return size


def open_file(uri: str):
    f, path = filesystem(uri)
    return f.open_input_file(path)


# -- text as byte arrays -------------------------------------------------------
def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if column.offset:
        column = pa.concat_arrays([column.slice(0, 0), column])
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents of about ``most`` bytes; a longer one stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(n, max(at + 1, end))
        yield at, end
        at = end


MULT = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd multiplier and of its inverse, modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", MULT), ("down", pow(MULT, -1, 1 << 64))):
                p = np.ones(1, np.uint64)
                while len(p) < size:
                    p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
                setattr(self, name, p)
        return self.up, self.down


POWERS = Powers()
#: A random value for each byte, so that sums over nearby byte values do not meet.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(MULT))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_VALUE = BYTE_VALUE[_LOWER]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash (uint64) and document number of each word ``[^\\x20\\x09-\\x0D]+`` of one
    run, with A-Z lower-cased; a word never crosses documents."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~IS_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    up, down = POWERS.upto(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(LOWER_VALUE[data] * up[:n], out=total[1:])
    found = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return found, np.searchsorted(offsets, starts, "right") - 1


def grams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document number and first word of each run of ``n`` words of one document."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.full(m, np.uint64(n), np.uint64)
    for i in range(n):
        total += hashes[i:i + m] * np.uint64(pow(MULT, i + 1, 1 << 64))
    at = np.flatnonzero(doc[:m] == doc[n - 1:])
    return mix(total[at]), doc[at], at


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> Iterator[np.ndarray]:
    """Per document of a run the sorted distinct ``n``-word shingles as hashes; with
    fewer words the whole sequence is one shingle, without words the set is empty."""
    hashes, doc = words(data, offsets)
    shingle, of, _ = grams(hashes, doc, n)
    docs = np.arange(len(offsets))
    cut, word_cut = np.searchsorted(of, docs), np.searchsorted(doc, docs)
    for i in range(len(offsets) - 1):
        own = shingle[cut[i]:cut[i + 1]]
        k = int(word_cut[i + 1] - word_cut[i])
        if not len(own) and k:
            own = grams(hashes[word_cut[i]:word_cut[i + 1]], np.zeros(k, np.int64), k)[0]
        yield np.unique(own)


def each_run(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = RUN_BYTES):
    """(batch, first row, end row, bytes, offsets) of each run of documents of the batches."""
    claim(None)
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        for a, b in runs(offsets, most):
            yield batch, a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
