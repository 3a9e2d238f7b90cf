"""Token-id files: one Zstandard frame per document under a shared dictionary.

The dictionary is trained on the serialised id arrays of a bounded sample of
documents (``sample_docs`` arrays, at most ``SAMPLE_BYTES`` of each).  All documents
are then encoded whole, each in a frame of its own, and written to shards in ascending
(doc_id, frame) order.  A shard is::

    b"TOKZ0001" | frames | doc_id int64[n] | has_id uint8[n] | end offset int64[n]
    | n_tokens int64[n] | n int64 | index offset int64 | sha256 of the dictionary
    | b"TOKZ0001"

so one short document takes two range reads (index and frame).  ``dictionary.zdict``
and ``manifest.json`` lie beside the shards; a reader compares the dictionary's hash.

Cases: a null text is an empty one and holds the end id alone; null doc_ids come first
and repeated rows stay, ordered by their frames; an empty table gives a store without
shards; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.session import materialize, work_dir

MAGIC = b"TOKZ0001"
#: Most bytes of one sampled array that dictionary training sees.
SAMPLE_BYTES = 16 << 10
#: Words that each of a worker's two cache generations holds, and the longest of them.
CACHE_WORDS, CACHE_CHARS = 600_000, 40
# Between non-space and non-space a single space opens a new pre-token of a byte-level
# tokenizer and a single line end is one, so such texts can be cut there without
# changing an id.  Texts with other white space are cut at their lone spaces only.
CUT = re.compile(r"(?<!\s) (?!\s)")
LATIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+")
# A run of ASCII marks after a letter is a pre-token of its own.
MARKED = re.compile(r"(.*[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f])([!-/:-@\[-`{-~]+)", re.DOTALL)


class Encoder:
    """Whole-text encoding by a byte-level tokenizer of the tokenizers library, each
    distinct word once as long as the cache holds it."""

    def __init__(self, path: str, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # Texts that spell an added token are left to the library, which yields its id.
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.model = self.tokenizer.model
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.width.itemsize]
        self.end = np.array([end_id], self.width).tobytes()
        # What byte-level pre-tokenization writes for each byte.
        show = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {b: show(bytes([b]).decode())[0][0] for b in range(128)}
        for c in map(chr, range(0xC0, 0x180)):
            self.shown.update(zip(c.encode(), show(c)[0][0], strict=True))
        self.space = self.shown[0x20]
        self.spaced, self.bare = _Words(self, " "), _Words(self, "")
        self.line, self.marks = self.whole("\n"), _Words(self, "")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()

    def word(self, word: str, before: str) -> bytes:
        """Ids of one word; a word of Latin letters alone is one pre-token."""
        if sys.byteorder != "little" or not LATIN.fullmatch(word):
            return self.whole(before + word)
        shown = self.space + word if before else word
        if not word.isascii():
            shown = (before + word).encode().decode("latin-1").translate(self.shown)
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Serialised ids of each text, the end id last."""
        out = []
        for text in texts:
            if self.added and self.added.search(text):
                out.append(self.whole(text) + self.end)
                continue
            first, *rest = text.split(" ")
            try:
                if "" in rest or not first:
                    raise Irregular
                ids = [self.bare[first], *map(self.spaced.__getitem__, rest), self.end]
            except Irregular:
                first, *rest = CUT.split(text)
                ids = [self.whole(first), *[self.whole(" " + w) for w in rest], self.end]
            out.append(b"".join(ids))
        return out


class Irregular(Exception):
    """White space that is not a single space or line end between words."""


class _Words(dict):
    """Ids by word, in two generations: a full one becomes the old one, and what is asked
    for again moves on to the new one."""

    def __init__(self, encoder: Encoder, before: str) -> None:
        self.encoder, self.before, self.old = encoder, before, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            parts = word.split()
            if len(parts) != 1 or parts[0] != word:
                if "\n".join(parts) != word or not parts:
                    raise Irregular
                return self.encoder.line.join([self[parts[0]], *map(self.encoder.bare.__getitem__, parts[1:])])
            marked = None if word[-1].isalnum() else MARKED.fullmatch(word)
            if marked:
                ids = self[marked[1]] + self.encoder.marks[marked[2]]
            else:
                ids = self.encoder.word(word, self.before)
        if len(word) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def encoder_of(path: str, end_id: int) -> Encoder:
    """One encoder per worker process, so that its cache outlives a task."""
    return Encoder(path, end_id)


def _encoded(docs: DataFrame, tokenizer: str, end_id: int, dictionary: bytes | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("token_store", encoder_of.cache_clear)
        encoder = encoder_of(tokenizer, end_id)
        pack = None
        if dictionary is not None:
            pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary)
                                            if dictionary else None).compress
        for batch in batches:
            _, offsets = common.utf8(batch.column("text"))
            for a, b in common.runs(offsets):
                ids = encoder.encode([t or "" for t in batch.column("text").slice(a, b - a).to_pylist()])
                counts = [len(x) // encoder.width.itemsize for x in ids]
                frames = [pack(x) for x in ids] if pack else [x[:SAMPLE_BYTES] for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a).cast(pa.int64()), pa.array(counts, pa.int64()),
                     pa.array(frames, pa.binary())], ["doc_id", "n_tokens", "frame"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, frame binary")


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_docs: int,
                     dictionary_bytes: int) -> bytes:
    """A dictionary from the arrays of the ``sample_docs`` documents of smallest hashed
    id; empty if they are too few to train on."""
    spark = docs.sparkSession
    ids = [r[0] for r in docs.select("doc_id").where("doc_id is not null").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).collect()]
    if not ids:
        return b""
    chosen = F.broadcast(spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    sample = _encoded(docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi"), tokenizer, end_id, None)
    arrays = [bytes(r[0]) for r in sample.select("frame").limit(sample_docs).collect()]
    try:
        return zstandard.train_dictionary(dictionary_bytes, arrays, level=3).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, sample_docs: int = 2000,
                 dictionary_bytes: int = 64 << 10, shard_bytes: int = 64 << 20) -> dict:
    """Write the store under ``path`` and return its manifest."""
    spark = docs.sparkSession
    common.small_batches(spark)
    dictionary = train_dictionary(docs, tokenizer, end_id, sample_docs, dictionary_bytes)
    mark = hashlib.sha256(dictionary).digest()
    encoded = materialize(_encoded(docs, tokenizer, end_id, dictionary), "token-frames")
    size = encoded.agg(F.sum(F.length("frame"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes), min(spark.sparkContext.defaultParallelism, size >> 20))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"shard-{TaskContext.get().partitionId():06d}.tokz"
        ids, counts, ends, at = [], [], [], len(MAGIC)

        def parts():
            nonlocal at
            yield MAGIC
            for batch in batches:
                frames = batch.column("frame").to_pylist()
                ids.append(batch.column("doc_id"))
                counts.append(batch.column("n_tokens").to_numpy())
                ends.append(at + np.cumsum([len(x) for x in frames], dtype=np.int64))
                at += sum(map(len, frames))
                yield b"".join(frames)
            every = pa.chunked_array(ids, pa.int64())
            yield every.fill_null(0).to_numpy().astype("<i8").tobytes()
            yield every.is_valid().to_numpy().astype("u1").tobytes()
            for x in (ends, counts):
                yield (np.concatenate(x) if x else np.zeros(0)).astype("<i8").tobytes()
            yield np.array([len(every), at], "<i8").tobytes() + mark + MAGIC

        written = common.write_file(f"{path}/{name}", parts())
        n = sum(len(x) for x in ids)
        if n:
            low = ids[0][0].as_py()
            yield pa.RecordBatch.from_pydict(
                {"shard": [name], "n": [n], "n_tokens": [int(sum(c.sum() for c in counts))],
                 "bytes": [written], "first_id": pa.array([low], pa.int64()),
                 "last_id": pa.array([ids[-1][-1].as_py()], pa.int64())})

    order = ["doc_id", F.xxhash64("frame"), "frame"]
    rows = (encoded.repartitionByRange(shards, *order).sortWithinPartitions(*order)
            .mapInArrow(write, "shard string, n long, n_tokens long, bytes long, first_id long, last_id long"))
    found = sorted(rows.collect(), key=lambda r: r.shard)
    manifest = {"dictionary_sha256": mark.hex(), "tokenizer_width": None, "end_id": end_id, "shards": []}
    start = 0
    for r in found:
        manifest["shards"].append(r.asDict() | {"start": start})
        start += r.n_tokens
    manifest |= {"n_tokens": start, "tokenizer_width": int(encoder_of(tokenizer, end_id).width.itemsize)}
    common.write_file(f"{path}/dictionary.zdict", [dictionary])
    common.write_file(f"{path}/manifest.json", [json.dumps(manifest).encode()])
    return manifest


class Shard:
    """One shard: the index in memory, frames by range reads."""

    def __init__(self, uri: str, dictionary: bytes, width: int) -> None:
        self.file, self.width = common.open_file(uri), width
        size, tail = self.file.size(), 16 + 32 + len(MAGIC)
        foot = self.file.read_at(tail, size - tail)
        if foot[-len(MAGIC):] != MAGIC or foot[16:48] != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{uri}: not a token file, or of another dictionary")
        self.n, at = (int(x) for x in np.frombuffer(foot[:16], "<i8"))
        index = self.file.read_at(size - tail - at, at)
        n = self.n
        self.ids = np.frombuffer(index[:8 * n], "<i8")
        self.has = np.frombuffer(index[8 * n:9 * n], "u1").astype(bool)
        self.ends = np.frombuffer(index[9 * n:17 * n], "<i8")
        self.counts = np.frombuffer(index[17 * n:25 * n], "<i8")
        self.unpack = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompress

    def tokens(self, a: int, b: int) -> list[np.ndarray]:
        """The id arrays of documents a to b of the shard, by one read."""
        begin = int(self.ends[a - 1]) if a else len(MAGIC)
        data = self.file.read_at(int(self.ends[b - 1]) - begin, begin)
        cut = [0, *(self.ends[a:b] - begin).tolist()]
        return [np.frombuffer(self.unpack(data[x:y]), f"<u{self.width}") for x, y in zip(cut, cut[1:], strict=False)]

    def find(self, doc_id: int) -> list[np.ndarray]:
        """All id arrays of a document id; ids ascend, so the index is searched by halving."""
        free = int((~self.has).sum())  # null ids come first
        a, b = (free + int(np.searchsorted(self.ids[free:], doc_id, s)) for s in ("left", "right"))
        return self.tokens(a, b) if a < b else []


def _store(path: str) -> tuple[dict, bytes]:
    with common.open_file(f"{path}/manifest.json") as f:
        manifest = json.loads(f.read())
    with common.open_file(f"{path}/dictionary.zdict") as f:
        return manifest, f.read()


def lookup(path: str, doc_id: int) -> list[np.ndarray]:
    """The id arrays of one document, from the one or few shards that may hold it."""
    manifest, dictionary = _store(path)
    return [x for s in manifest["shards"] if s["last_id"] is not None
            and (s["first_id"] is None or s["first_id"] <= doc_id) and doc_id <= s["last_id"]
            for x in Shard(f"{path}/{s['shard']}", dictionary, manifest["tokenizer_width"]).find(doc_id)]


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and its ids if asked for."""
    manifest, dictionary = _store(path)
    width = manifest["tokenizer_width"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(f"{path}/{row['shard']}", dictionary, width)
                before = row["start"] + np.cumsum(shard.counts) - shard.counts
                sizes = np.concatenate([[len(MAGIC)], shard.ends])
                for a, b in common.runs(sizes):
                    arrays = shard.tokens(a, b)
                    out = [pa.array(shard.ids[a:b], mask=~shard.has[a:b]), pa.array(before[a:b]),
                           pa.array([len(x) for x in arrays], pa.int64()),
                           pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in arrays], pa.int64())]
                    if ids:
                        out.append(pa.array([x.astype(np.int32) for x in arrays], pa.list_(pa.int32())))
                    yield pa.RecordBatch.from_arrays(out, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(out)])

    rows = [(s["shard"], s["start"]) for s in manifest["shards"]]
    files = spark.createDataFrame(rows, "shard string, start long")
    return files.repartition(max(1, len(rows)), "shard").mapInArrow(read, schema)


def token_store(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` as token files in the session's shared folder, then read them back."""
    path = work_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, **options)
    return read_tokens(docs.sparkSession, path)
