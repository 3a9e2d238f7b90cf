"""Removal of repeated substrings across documents, by bytes, with a Burrows-Wheeler transform.

A byte goes if some string of ``WINDOW`` bytes that covers it also starts in a document
with a smaller doc_id; strings are judged on the input.

1. Documents are written once as chunks of about ``CHUNK`` bytes.  A chunk's work is
   repeated from those files, so nothing depends on how rows came in.
2. Every window has an anchor (``anchors.py``) that equal windows share.  Each chunk
   sends the distinct hashes of its anchors to buckets, a few bytes each, and learns
   which occur in more than one document.
3. For these it sends a hash of the context, all bytes that windows around the anchor
   can cover, and the smallest document that has it.  Copies collapse within a chunk
   before they are sent, so a group of copies costs one entry a chunk.
4. Where an anchor has one context only, the smallest document decides.  Contexts that
   differ may still share windows: one copy of each is sent to the anchor's bucket.
   There they are joined to one text with an end mark each, whose transform is
   extended backwards breadth-first: level by level every interval of suffixes with a
   common prefix of l bytes is extended by the byte before it, which gives all common
   prefixes of l + 1 bytes, up to WINDOW, where it stops.  The smallest document of each
   interval left is that of all strings of WINDOW bytes.
5. An anchor with more contexts than ``HOT``, counted once a chunk, takes no part in 3
   and 4: its windows are dealt by their own hash, with the smallest document of each
   chunk, so that no bucket holds all that surrounds a common passage.
6. Each chunk learns these documents for its contexts and windows, removes and counts.

Anchors are dealt to buckets by hash, so a task holds a bounded number; contexts of a
bucket are transformed in groups of about ``GROUP`` bytes that never part an anchor.

Cases: a null text is an empty one; documents shorter than WINDOW keep all; rows of one
doc_id do not remove each other; a null doc_id is larger than any other, and such rows do
not remove each other; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.llm.anchors import GRAM, WINDOW, anchors
from kinora.session import materialize, work_dir

CHUNK, GROUP = 8 << 20, 1 << 17
#: Contexts of one anchor that are transformed together.
HOT = GROUP // (2 * WINDOW - GRAM)
#: Anchors of a bucket, as bytes of text they come from (one anchor in about 13 bytes).
BUCKET_BYTES = 8 << 20
NOBODY = np.int64(2**63 - 1)


def _chunks(docs: DataFrame) -> DataFrame:
    """chunk, document ids, offsets and bytes, several documents a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, sizes, data = TaskContext.get().partitionId() << 32, [], [], []

        def row():
            nonlocal number
            out = pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                pa.array([np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64).tobytes()], pa.binary()),
                pa.array([np.concatenate(data).tobytes()], pa.binary())], ["chunk", "ids", "offsets", "data"])
            number += 1
            return out

        for batch, a, b, own, offsets in common.each_run(batches):
            if data and sum(map(len, data)) + len(own) > CHUNK:
                yield row()
                ids, sizes, data = [], [], []
            ids.append(batch.column("doc_id").slice(a, b - a).cast(pa.int64()).fill_null(int(NOBODY)).to_numpy())
            sizes.append(np.diff(offsets))
            data.append(own)
        if data:
            yield row()
    return docs.select("doc_id", "text").mapInArrow(run, "chunk long, ids binary, offsets binary, data binary")


def _stored(chunks: DataFrame) -> DataFrame:
    """The chunks as a table in the shared folder that is bucketed by chunk, so that what
    the buckets of anchors answer is joined without moving the texts again."""
    spark = chunks.sparkSession
    name = f"kinora_chunks_{uuid.uuid4().hex[:12]}"
    (chunks.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").format("parquet")
     .option("path", work_dir(spark, "chunks")).saveAsTable(name))
    return spark.table(name)


def _read(batch: pa.RecordBatch, i: int):
    """One chunk's document ids, offsets and bytes."""
    get = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)
    return get("ids", np.int64), get("offsets", np.int64), get("data", np.uint8)


def _runs(offsets: np.ndarray, data: np.ndarray):
    """Anchors of a chunk in runs of documents; a document that is too long for the
    anchors' places is cut into parts that overlap by more than any context reaches."""
    most, lap = (1 << 24) - (1 << 12), 4 * WINDOW
    for a, b in common.runs(offsets):
        low, high = int(offsets[a]), int(offsets[b])
        if high - low <= most:
            yield low, a, anchors(data[low:high], offsets[a:b + 1] - low)
            continue
        for at in range(low, high - lap, most - lap):
            yield at, a, anchors(data[at:min(at + most, high)], np.array([0, min(most, high - at)]))


def _entries(ids: np.ndarray, offsets: np.ndarray, data: np.ndarray):
    """(document, gram, context start, context end, context hash, doc_id) of a chunk's anchors."""
    parts = [(doc + a, gram, start + low, end + low, context, ids[doc + a])
             for low, a, (_, doc, gram, start, end, context) in _runs(offsets, data)]
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _least(keys: np.ndarray, values: np.ndarray):
    """Distinct keys in order with the least and the largest of their values, and a place of each."""
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if not len(first):
        return keys, values, values, order
    return keys[first], np.minimum.reduceat(values, first), np.maximum.reduceat(values, first), order[first]


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which of the values are in a sorted list."""
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def _pack(*arrays: np.ndarray) -> list[bytes]:
    pack = zstandard.ZstdCompressor(level=1).compress
    return [pack(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()) for a in arrays]


def _unpack(blob, kind) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    size = np.dtype(kind).itemsize
    return np.frombuffer(np.frombuffer(raw, np.uint8).reshape(size, -1).T.tobytes(), kind)


def _bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    return ((gram >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _rows(columns: dict) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "chunk": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in columns.items()], list(columns))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each bucket, of a stream in bucket order."""
    key, own = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] != key:
                if own:
                    yield key, own
                key, own = row["bucket"], []
            own.append(row)
    if own:
        yield key, own


def _sorted(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n, "bucket").sortWithinPartitions("bucket", "chunk")


# -- 2: which anchors occur in more than one document ---------------------------
def _hashes(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, gram, _, _, context, doc = _entries(*_read(batch, i))
                # Bucket above, 32 bits of the hash below: enough to find copies.
                anchor = _bucket(gram, buckets).astype(np.uint64) << np.uint64(32) | gram & np.uint64(0xFFFFFFFF)
                key, low, high, _ = _least(anchor, doc)
                different = np.unique(context, return_index=True)[1]
                count = np.bincount(np.searchsorted(key, anchor[different]), minlength=len(key)).astype(np.uint32)
                of = (key >> np.uint64(32)).astype(np.int64)
                cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else []
                for a, b in zip(cut, cut[1:], strict=False):
                    yield _rows({"bucket": [int(of[a])], "chunk": [batch.column("chunk")[i].as_py()],
                                 "hashes": _pack(np.diff(key[a:b].astype(np.uint32), prepend=np.uint32(0))),
                                 "several": [np.packbits(low[a:b] != high[a:b]).tobytes()], "counts": _pack(count[a:b])})
    return chunks.mapInArrow(run, "bucket int, chunk long, hashes binary, several binary, counts binary")


def _shared(hashes: DataFrame, n: int) -> DataFrame:
    """Per chunk and bucket the hashes that another document has too, those of anchors with
    more than ``HOT`` contexts apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            own = [np.cumsum(_unpack(r["hashes"], np.uint32), dtype=np.uint32) for r in rows]
            flags = [np.unpackbits(np.frombuffer(r["several"], np.uint8), count=len(h)).astype(bool) for r, h in zip(rows, own, strict=True)]
            every = np.sort(np.concatenate(own + [h[f] for h, f in zip(own, flags, strict=True)]))
            more = every[1:][every[1:] == every[:-1]]
            more = more[np.concatenate([[True], more[1:] != more[:-1]])] if len(more) else more
            total = np.zeros(len(more), np.int64)  # contexts
            found = [_among(h, more) for h in own]
            for r, h, f in zip(rows, own, found, strict=True):
                total[np.searchsorted(more, h[f])] += _unpack(r["counts"], np.uint32)[f]
            many = more[total > HOT]
            for r, h, f in zip(rows, own, found, strict=True):
                if f.any():
                    hot = f & _among(h, many)
                    yield _rows({"bucket": [bucket], "chunk": [r["chunk"]], "hashes": _pack(h[f & ~hot]), "hot": _pack(h[hot]) if hot.any() else [None]})
    return _sorted(hashes, n).mapInArrow(run, "bucket int, chunk long, hashes binary, hot binary")


# -- 3: contexts of these anchors -----------------------------------------------
def _with(chunks: DataFrame, replies: DataFrame, *columns: str) -> DataFrame:
    """Chunks with what the buckets answered, as arrays over the buckets; a bounded number a chunk."""
    per = replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", *columns)).alias("replies"))
    return chunks.join(per, "chunk", "left")


def _contexts(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                replies = batch.column("replies")[i].as_py()
                if not replies:
                    continue
                _, gram, _, _, context, doc = _entries(*_read(batch, i))
                bucket, h = _bucket(gram, buckets), gram.astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for r in replies:
                    own = order[cut[r["bucket"]]:cut[r["bucket"] + 1]]
                    own = own[_among(h[own], _unpack(r["hashes"], np.uint32))]
                    if not len(own):
                        continue
                    keys, low, high, first = _least(context[own], doc[own])
                    names = ("hashes", "contexts", "low", "high")
                    yield _rows({"bucket": [r["bucket"]], "chunk": [batch.column("chunk")[i].as_py()]} |
                                {k: [v] for k, v in zip(names, _pack(h[own][first], keys, low, high - low), strict=True)})
    return chunks.mapInArrow(run, "bucket int, chunk long, hashes binary, contexts binary, low binary, high binary")


def _gathered(rows: list[dict]):
    """A bucket's entries of all chunks: (hash, context, least doc, whether others, row number)."""
    parts = [(_unpack(r["hashes"], np.uint32), _unpack(r["contexts"], np.uint64), _unpack(r["low"], np.int64), _unpack(r["high"], np.int64)) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(p[0]) for p in parts])
    h, c, low, more = (np.concatenate(x) for x in zip(*parts, strict=True))
    return h, c, low, low + more, row


def _wanted(contexts: DataFrame, n: int) -> DataFrame:
    """Per chunk the contexts whose bytes it must send: of anchors with several contexts
    in several documents, each from the first chunk of its least document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            h, c, low, high, row = _gathered(rows)
            order = np.lexsort((row, low, c, h))
            h, c, low, high, row = (x[order] for x in (h, c, low, high, row))
            anchor = np.concatenate([[True], h[1:] != h[:-1]])
            single = anchor | np.concatenate([[True], c[1:] != c[:-1]])
            at = np.flatnonzero(anchor)
            group = np.cumsum(anchor) - 1
            several = (np.add.reduceat(single.astype(np.int64), at) > 1) & (np.minimum.reduceat(low, at) < np.maximum.reduceat(high, at))
            pick = np.flatnonzero(single & several[group])
            for i in np.unique(row[pick]).tolist():
                own = pick[row[pick] == i]
                yield _rows({"bucket": [bucket], "chunk": [rows[i]["chunk"]], "contexts": _pack(np.sort(c[own]))})
    return _sorted(contexts, n).mapInArrow(run, "bucket int, chunk long, contexts binary")


def _bytes(chunks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                replies = batch.column("replies")[i].as_py()
                if not replies:
                    continue
                ids, offsets, data = _read(batch, i)
                _, gram, start, end, context, _ = _entries(ids, offsets, data)
                known, first = np.unique(context, return_index=True)
                for r in replies:
                    own = first[np.searchsorted(known, _unpack(r["contexts"], np.uint64))]
                    texts = zstandard.ZstdCompressor(level=1).compress(b"".join([data[a:b].tobytes() for a, b in zip(start[own].tolist(), end[own].tolist(), strict=True)]))
                    packed = _pack(gram[own].astype(np.uint32), context[own], (end - start)[own].astype(np.uint8))
                    yield _rows({"bucket": [r["bucket"]], "chunk": [batch.column("chunk")[i].as_py()], "hashes": [packed[0]],
                                 "contexts": [packed[1]], "low": [packed[2]], "high": [texts]})
    return chunks.mapInArrow(run, "bucket int, chunk long, hashes binary, contexts binary, low binary, high binary")


# -- 4: the transform -------------------------------------------------------------
def suffix_order(text: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Suffixes, up to their end mark (0), of a text of uint16 symbols in order, equal ones
    by their owner: by doubling from seven packed symbols on."""
    n, width = len(text), 7
    ended = text == 0
    key = np.zeros(n, np.int64)
    live = np.ones(n, bool)  # no end mark so far
    for i in range(width):
        live[:n - i] &= ~ended[i:]
        key <<= 9
        key[:n - i] |= np.where(live[:n - i], text[i:], 0)
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if not live.any():
            return np.argsort(rank * len(text) + owner)
        nxt = np.zeros(n, np.int64)
        nxt[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + np.where(live, nxt, 0)
        live[:n - width] &= live[width:]
        live[n - width:] = False
        width *= 2


def common_intervals(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """The interval, in suffix order, of each suffix among those with the same first
    ``most`` symbols, by breadth-first backward extension on the transform; every end
    mark counts as a symbol of its own."""
    before = text[order - 1]  # the transform: the symbol before each suffix
    back = np.argsort(before, kind="stable").astype(np.int32)  # suffix i of the extended string comes from back[i]
    starts = text[order]
    other = np.concatenate([[True], starts[1:] != starts[:-1]]) | (starts == 0)
    edge = other.copy()  # intervals of one symbol
    for _ in range(1, most):
        interval = np.cumsum(edge, dtype=np.int32)[back]
        edge = other.copy()
        edge[1:] |= interval[1:] != interval[:-1]
        if edge.all():
            break
    return np.cumsum(edge) - 1


def least_documents(texts: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each text and each string of WINDOW bytes in it the least document of all
    texts with that string."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts])
    size = sizes + 1
    last = np.cumsum(size) - 1
    text = np.frombuffer(b"\0".join([*texts, b""]), np.uint8).astype(np.uint16) + np.uint16(1)
    text[last] = 0
    owner = np.repeat(np.arange(n), size)
    order = suffix_order(text, owner)
    interval = common_intervals(text, order, WINDOW)
    left = last[owner] - np.arange(len(text))
    value = np.where(left >= WINDOW, docs[owner], NOBODY)
    first = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
    found = np.empty(len(text), np.int64)
    found[order] = np.minimum.reduceat(value[order], first)[interval]
    start = last - sizes
    return [found[s:s + max(0, k - WINDOW + 1)] for s, k in zip(start.tolist(), sizes.tolist(), strict=True)]


def _answers(contexts: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Per chunk: contexts with one least document, and contexts with one for each string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, both in _by_bucket(batches):
            rows = [r for r in both if not r["texts"]]
            h, c, low, high, row = _gathered(rows)
            known, least, _, _ = _least(c, low)
            many: dict[int, np.ndarray] = {}
            sent = [r for r in both if r["texts"]]
            if sent:
                own_h = np.concatenate([_unpack(r["hashes"], np.uint32) for r in sent])
                own_c = np.concatenate([_unpack(r["contexts"], np.uint64) for r in sent])
                parts = []
                for r in sent:
                    cut = np.concatenate([[0], np.cumsum(_unpack(r["low"], np.uint8), dtype=np.int64)]).tolist()
                    raw = zstandard.ZstdDecompressor().decompress(r["high"])
                    parts += [raw[x:y] for x, y in zip(cut, cut[1:], strict=False)]
                order = np.lexsort((own_c, own_h))
                size = np.cumsum([len(parts[i]) for i in order])
                # Groups of about GROUP bytes that end between two anchors.
                turn = np.flatnonzero(np.concatenate([own_h[order][1:] != own_h[order][:-1], [True]])) + 1
                cuts, at = [0], 0
                for t in turn.tolist():
                    if size[t - 1] - at >= GROUP or t == len(order):
                        cuts.append(t)
                        at = size[t - 1]
                for a, b in zip(cuts, cuts[1:], strict=False):
                    own = order[a:b]
                    docs = least[np.searchsorted(known, own_c[own])]
                    for i, d, m in zip(own.tolist(), docs.tolist(), least_documents([parts[i] for i in own], docs), strict=True):
                        if len(m) and (m != d).any():  # else the context's own least document says all
                            many[int(own_c[i])] = m
            listed = np.array(sorted(many), np.uint64)
            for i, r in enumerate(rows):
                own = row == i
                mine, top = c[own], high[own]
                m = least[np.searchsorted(known, mine)]
                other = _among(mine, listed)
                plain, odd = (m < top) & ~other, mine[other]
                if plain.any() or len(odd):
                    vectors = [many[int(x)] for x in odd.tolist()]
                    blobs = _pack(mine[plain], m[plain], odd, np.array([len(v) for v in vectors], np.uint8), np.concatenate([*vectors, np.zeros(0, np.int64)]))
                    yield _rows({"bucket": [bucket], "chunk": [r["chunk"]]} | {k: [v] for k, v in zip(("one", "least", "odd", "sizes", "each"), blobs, strict=True)})
    names = ["bucket", "chunk", "hashes", "contexts", "low", "high"]
    both = contexts.select(*names, F.lit(False).alias("texts")).unionByName(texts.select(*names, F.lit(True).alias("texts")))
    return _sorted(both, n).mapInArrow(run, "bucket int, chunk long, one binary, least binary, odd binary, sizes binary, each binary")


# -- 5: windows of anchors with many contexts ----------------------------------------
def _windows(offsets: np.ndarray, data: np.ndarray, ids: np.ndarray, entries, hot: np.ndarray):
    """(place, hash, doc_id) of each window in the contexts of the listed anchors."""
    _, gram, start, end, _, _ = entries
    own = _among(gram.astype(np.uint32), hot)
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, start[own], 1)
    np.add.at(edge, end[own] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    total = np.zeros(len(at), np.uint64)
    for i in range(WINDOW):
        total += common.BYTE_VALUE[data[at + i]] * np.uint64(pow(common.MULT, i + 1, 1 << 64))
    return at, common.mix(total), ids[np.searchsorted(offsets, at, "right") - 1]


def _hot(replies: list[dict]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint32), *(_unpack(r["hot"], np.uint32) for r in replies if r["hot"])]))


def _strings(chunks: DataFrame, buckets: int) -> DataFrame:
    """Per bucket of windows those of each chunk with their least and largest document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                replies = batch.column("replies")[i].as_py()
                if not replies:
                    continue
                ids, offsets, data = _read(batch, i)
                _, window, doc = _windows(offsets, data, ids, _entries(ids, offsets, data), _hot(replies))
                key, low, high, _ = _least(window, doc)
                bucket = _bucket(key, buckets)
                order = np.argsort(bucket, kind="stable")
                cut = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
                for a, b in zip(cut, cut[1:], strict=False):
                    own = order[a:b]
                    packed = _pack(key[own], low[own], high[own] - low[own])
                    yield _rows({"bucket": [int(bucket[own[0]])], "chunk": [batch.column("chunk")[i].as_py()]} |
                                {k: [v] for k, v in zip(("windows", "low", "high"), packed, strict=True)})
    return chunks.mapInArrow(run, "bucket int, chunk long, windows binary, low binary, high binary")


def _earlier(strings: DataFrame, n: int) -> DataFrame:
    """Per chunk the windows that a smaller document than some of its own has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_bucket(batches):
            keys, low, high = ([_unpack(r[k], t) for r in rows] for k, t in (("windows", np.uint64), ("low", np.int64), ("high", np.int64)))
            known, least, _, _ = _least(np.concatenate(keys), np.concatenate(low))
            for r, k, a, more in zip(rows, keys, low, high, strict=True):
                m = least[np.searchsorted(known, k)]
                if (odd := m < a + more).any():
                    packed = _pack(k[odd], m[odd])
                    yield _rows({"bucket": [bucket], "chunk": [r["chunk"]], "windows": [packed[0]], "least": [packed[1]]})
    return _sorted(strings, n).mapInArrow(run, "bucket int, chunk long, windows binary, least binary")


# -- 6: removal -------------------------------------------------------------------
def _cover(ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, replies: list[dict]) -> np.ndarray:
    """Which bytes of a chunk go."""
    edge = np.zeros(len(data) + 1, np.int64)
    entries = _entries(ids, offsets, data)
    _, _, start, end, context, doc = entries
    order = np.argsort(context, kind="stable")
    ordered = context[order]

    def places(keys: np.ndarray):
        """(number of the key, place) of every anchor with one of the keys."""
        low, high = np.searchsorted(ordered, keys, "left"), np.searchsorted(ordered, keys, "right")
        count = high - low
        which = np.repeat(np.arange(len(keys)), count)
        return which, order[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]

    if any(r["windows"] for r in replies):
        known, least, _, _ = _least(*(np.concatenate([_unpack(r[k], t) for r in replies if r["windows"]]) for k, t in (("windows", np.uint64), ("least", np.int64))))
        at, window, own = _windows(offsets, data, ids, entries, _hot(replies))
        at = at[_among(window, known) & (least[np.minimum(np.searchsorted(known, window), len(known) - 1)] < own)]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
    for r in replies:
        if not r["one"]:
            continue
        which, at = places(_unpack(r["one"], np.uint64))
        at = at[_unpack(r["least"], np.int64)[which] < doc[at]]
        np.add.at(edge, start[at], 1)
        np.add.at(edge, end[at], -1)
        sizes, each = _unpack(r["sizes"], np.uint8).astype(np.int64), _unpack(r["each"], np.int64)
        which, at = places(_unpack(r["odd"], np.uint64))
        begin = np.cumsum(sizes) - sizes
        n = sizes[which]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        less = each[np.repeat(begin[which], n) + step] < np.repeat(doc[at], n)
        window = (np.repeat(start[at], n) + step)[less]
        np.add.at(edge, window, 1)
        np.add.at(edge, window + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _removed(chunks: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, offsets, data = _read(batch, i)
                gone = _cover(ids, offsets, data, batch.column("replies")[i].as_py() or [])
                kept, out = ~gone, []
                for d in range(len(ids)):
                    a, b = offsets[d], offsets[d + 1]
                    g = gone[a:b]
                    spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                    out.append((b - a, g.sum(), spans, data[a:b][kept[a:b]].tobytes()))
                n_bytes, n_removed, n_spans, rest = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=ids == NOBODY), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                                                  pa.array(n_spans, pa.int64()), pa.array(rest, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return chunks.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes kept, per row."""
    spark = docs.sparkSession
    common.small_batches(spark)
    chunks = _stored(_chunks(docs))
    size = chunks.agg(F.sum(F.length("data"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    n = int(min(buckets, 20_000))
    shared = materialize(_shared(_hashes(chunks, buckets), n), "shared")
    contexts = materialize(_contexts(_with(chunks, shared, "hashes"), buckets), "contexts")
    wanted = _wanted(contexts, n)
    texts = _bytes(_with(chunks, wanted, "contexts"), buckets)
    answers = _answers(contexts, texts, n).withColumns({"windows": F.lit(None).cast("binary"), "hot": F.lit(None).cast("binary")})
    hot = shared.where("hot is not null").select("bucket", "chunk", "hot")
    if not hot.isEmpty():
        earlier = _earlier(_strings(_with(chunks, hot, "hot"), buckets), n)
        answers = answers.unionByName(earlier, allowMissingColumns=True).unionByName(hot, allowMissingColumns=True)
    return _removed(_with(chunks, answers, "one", "least", "odd", "sizes", "each", "windows", "hot"))


def digest(rows: DataFrame) -> DataFrame:
    return rows.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
