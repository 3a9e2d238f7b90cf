"""Toxicity by class-conditional Kneser-Ney models over the bytes of words.

Each class, toxic and ordinary, has counts of the n-grams (up to ``ORDER`` bytes, word
start included) that end at each byte of a word.  A byte's probability in a class is
interpolated Kneser-Ney: the class's discounted count in its longest context, the rest
from a backoff distribution that both classes share, so that an expression that neither or
hardly any document shows is judged alike by both.  The shared distribution is Kneser-Ney
over all shorter orders: each takes the discounted number of distinct bytes that stand
before an n-gram and leaves the rest to the next shorter order, down to single bytes and
then to all ``SYMBOLS`` alike.  Where a context was seen by neither class, both fall to the
same shared distribution, whatever its order, so the byte's difference is exactly zero.

A word's score is the difference of its two log-likelihoods per byte.  A document is
described by the difference per byte over the whole text and by its few strongest words,
again per byte; a logistic calibration on labelled documents that the counts did not see
turns that into a score between 0 and 1.

The models are fitted on the whole texts of all labelled rows: three quarters of them are
counted, the rest calibrates.  Every n-gram is in the model, whatever its count.  Every
document is scored on its whole text, from the text alone.

Nothing that grows is broadcast or brought to the driver.  Words are counted first, and
the n-grams of the distinct words from those counts.  All shorter n-grams and contexts
that an n-gram's probability rests on, but the single bytes and pairs, share the two bytes
before its last; so the counts are dealt by those and a task works out all orders of its
n-grams.  The tables stay in Spark.  A word's score rests on the word alone: the distinct
words of the documents are joined with the tables, and texts do not move.  Rows that
follow each other in a file belong to a block, whichever way the file is split; each
block's words get a file of their scores, which the tasks that read the block's documents
open.  Labels meet the documents in the same way.

Cases: null and empty texts, or texts without words, score as the calibration puts a
text of no evidence; repeated rows score alike; without labelled rows of both classes
every score is 0; a label that is null or not 0 or 1 is not used and a
document with both labels is toxic; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinora.llm import common
from kinora.session import materialize, work_dir

ORDER = 12
DISCOUNT = 0.75
#: Text that is looked up at once; its n-grams take some hundred bytes a letter.
RUN_BYTES = 1 << 18
#: Distinct words that a task holds before it passes them on.
HELD_ROWS = 1 << 18
#: N-grams that are worked out at once, unless a single group has more, and those of a task.
GROUP_ROWS, TASK_ROWS = 1 << 16, 1 << 19
#: Rows of a file that go to the same block, and rows of a block.
RUN_ROWS, BLOCK_ROWS = 1 << 13, 1 << 16
#: Words whose n-grams are made at once.
WORDS = 1 << 13
#: Beginnings of table entries that no three bytes name.
SHORT, INNER = -1, -2
#: Groups that the others are dealt to.
BEGINNINGS = 1009
#: Strongest words of a document that count beside the whole.
TOP = 2
_LOW = common._LOWER.copy()
# Letters are ASCII letters and every byte of a longer UTF-8 character; all else parts words.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOW[~_LETTER] = 0x20
#: Bytes that an n-gram can hold: lower-case letters, those of longer characters, a space.
SYMBOLS = len(np.unique(_LOW))


def word_bytes(data: np.ndarray, offsets: np.ndarray):
    """(start, length, document, hash) of each word of letters of one run, lower-cased."""
    letter = _LETTER[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[:-1]] = True
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | edge[1:len(data)]
    end[:-1] &= ~letter[1:] | edge[1:len(data)]
    starts = np.flatnonzero(begin)
    lengths = np.flatnonzero(end) + 1 - starts
    up, down = common.POWERS.upto(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(common.BYTE_VALUE[_LOW[data]] * up[:len(data)], out=total[1:])
    hashes = common.mix((total[starts + lengths] - total[starts]) * down[starts] + lengths.astype(np.uint64))
    return starts, lengths, np.searchsorted(offsets, starts, "right") - 1, hashes


def _placed(starts: np.ndarray, lengths: np.ndarray):
    """For every byte of the given words, and for the word's end: the word's number, the
    place in a layout of the words one after another, each after a space, whether it is a
    letter, its place in the word, and how many bytes before it belong to its n-gram."""
    size = lengths + 1
    word = np.repeat(np.arange(len(starts)), size)
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) - first[word]  # 0 is the first letter, length the end
    return word, np.arange(len(word)) + word + 1, at < lengths[word], at, np.minimum(at + 1, ORDER - 1)


def ngram_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """For every byte of the given words, and for the word's end: the word's number, and
    the hash of the longest n-gram that ends there and of its context.  A space stands
    before and after a word."""
    word, slot, letters, at, depth = _placed(starts, lengths)
    flat = np.full(len(word) + len(starts), common.BYTE_VALUE[0x20], np.uint64)
    flat[slot[letters]] = common.BYTE_VALUE[_LOW[data[starts[word[letters]] + at[letters]]]]
    whole = np.zeros(len(word), np.uint64)
    for back in range(ORDER):
        value = flat[np.maximum(slot - back, 0)] * np.uint64(pow(common.MULT, back + 1, 1 << 64))
        whole += np.where(back <= depth, value, 0)
    return (word, *_hashed(whole, flat[slot], depth))


def _hashed(whole: np.ndarray, own: np.ndarray, depth: np.ndarray):
    """Hashes of n-grams and of their contexts from the sum over their bytes and the last one's value."""
    n = depth.astype(np.uint64)
    return common.mix(whole + n), common.mix(whole - own * np.uint64(common.MULT) + n + np.uint64(100))


def ngram_bytes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The n-grams of ``ngram_keys`` themselves: the word's number, their last eight bytes
    and those before as two whole numbers, zero where there are fewer."""
    word, slot, letters, at, depth = _placed(starts, lengths)
    flat = np.full(len(word) + len(starts), 0x20, np.uint64)
    flat[slot[letters]] = _LOW[data[starts[word[letters]] + at[letters]]]
    tail, head = np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
    for back in range(ORDER):
        into, shift = (tail, 8 * back) if back < 8 else (head, 8 * (back - 8))
        into |= np.where(back <= depth, flat[np.maximum(slot - back, 0)], 0).astype(np.uint64) << np.uint64(shift)
    return word, head, tail


def spelled(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The given words, lower-cased, as a binary column."""
    ends = np.cumsum(lengths)
    flat = _LOW[data[np.arange(lengths.sum()) + np.repeat(starts - ends + lengths, lengths)]]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = WORDS) -> Iterator[pa.Table]:
    """Batches put together to tables of about ``rows`` rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _word_column(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, length) of a binary column of words."""
    words = column.combine_chunks().cast(pa.large_binary())
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets[:-1] - offsets[0], np.diff(offsets)


def _merged(found: Iterator[pa.RecordBatch], keys: list[str], sums: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a task with equal keys summed up, as far as HELD_ROWS distinct ones reach."""
    held, size = [], 0

    def merge() -> pa.Table:
        out = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([(c, "sum") for c in sums])
        return pa.table([out.column(c) for c in keys] + [out.column(f"{c}_sum") for c in sums], [*keys, *sums])
    for batch in found:
        held.append(batch)
        size += batch.num_rows
        if size > HELD_ROWS:
            out = merge()
            held, size = out.to_batches(), out.num_rows
            if size > HELD_ROWS // 4 * 3:
                yield from out.to_batches(max_chunksize=1 << 14)
                held, size = [], 0
            del out
            pa.default_memory_pool().release_unused()
    if size:
        yield from merge().to_batches(max_chunksize=1 << 14)
    del held
    pa.default_memory_pool().release_unused()


def _words(docs: DataFrame, pick) -> DataFrame:
    """(word, toxic count, ordinary count) of each word of the texts that ``pick`` leaves."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, data, offsets in common.each_run(batches, most=RUN_BYTES):
            starts, lengths, doc, hashes = word_bytes(data, offsets)
            toxic = batch.column("toxic").to_numpy()[a:b][doc]
            _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
            counts = [np.bincount(of, weights=toxic == k, minlength=len(first)).astype(np.int64) for k in (1, 0)]
            yield pa.RecordBatch.from_arrays([spelled(data, starts[first], lengths[first]), *map(pa.array, counts)], ["word", "t", "o"])

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged(each(pick(batches)), ["word"], ["t", "o"])
    # Words that begin alike meet in a task, and so do most of their n-grams.
    found = docs.mapInArrow(run, "word binary, t long, o long").withColumn("begins", F.substring("word", 1, 3))
    return found.repartition("begins").groupBy("begins", "word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _summed(head: np.ndarray, tail: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """Distinct (head, tail) with the sums of their counts."""
    order = np.lexsort((tail, head))
    head, tail = head[order], tail[order]
    new = np.ones(len(head), bool)
    new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
    begin = np.flatnonzero(new)
    return [head[begin], tail[begin], *(np.add.reduceat(c[order], begin) for c in counts)]


def _count(docs: DataFrame, pick=iter) -> DataFrame:
    """(head, tail, toxic count, ordinary count) of the n-grams of the texts that ``pick``
    leaves, from the words' counts; an n-gram may come in several rows."""
    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            word, head, tail = ngram_bytes(*_word_column(table.column("word")))
            head, tail, t, o = _summed(head, tail, *(table.column(c).to_numpy()[word] for c in ("t", "o")))
            yield pa.RecordBatch.from_arrays([pa.array(head.view(np.int64)), pa.array(tail.view(np.int64)), pa.array(t), pa.array(o)], ["head", "tail", "t", "o"])
    return _words(docs, pick).select("word", "t", "o").mapInArrow(run, "head long, tail long, t long, o long")


@dataclass
class Model:
    """The stored tables of log-likelihood differences, of n-grams and of an unseen
    continuation of contexts, and the calibration's weights."""
    tables: DataFrame | None
    weights: np.ndarray

    @property
    def keys(self) -> np.ndarray:
        """Sorted hashes of the n-grams, to look at small models."""
        return _arrays(self.tables)[0] if self.tables else np.zeros(0, np.uint64)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights[:-1] + self.weights[-1], -30, 30)))


def single_bytes(pairs: np.ndarray) -> np.ndarray:
    """The shared distribution of single bytes, by value, from the distinct pairs of bytes
    (as ``before * 256 + byte``) that end an n-gram."""
    n = np.bincount(pairs & 255, minlength=256).astype(np.float64)
    return (np.maximum(n - DISCOUNT, 0) + DISCOUNT * (n > 0).sum() / SYMBOLS) / n.sum()


def pair_bytes(before: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The shared distribution of a byte after another, [first, second], from the number
    of distinct bytes that stand before each pair."""
    total, kinds = before.sum(axis=1, keepdims=True), (before > 0).sum(axis=1, keepdims=True)
    return (np.maximum(before - DISCOUNT, 0) + DISCOUNT * kinds * single) / np.maximum(total, 1)


def estimate(head: np.ndarray, tail: np.ndarray, t: np.ndarray, o: np.ndarray, single: np.ndarray, pair: np.ndarray):
    """Kneser-Ney tables (keys, values, beginnings, contexts, backoff, beginnings) from all
    n-grams that have one of some pairs of bytes before the last, with the counts of both
    classes.  A beginning is that of the words that look an entry up: their first three
    bytes, SHORT for an n-gram of four bytes or a shorter one, or for a context of such,
    and INNER for one that does not begin a word.

    Strings are numbered from their end: those of m bytes by the number of their last
    m - 1 and the byte before, and contexts likewise without the last byte."""
    n = len(head)
    back = [((tail if i < 8 else head) >> np.uint64(8 * (i % 8))).astype(np.int64) & 255 for i in range(ORDER)]
    length = sum((b > 0).astype(np.int64) for b in back)
    lower = single[back[0]]  # of each n-gram's ending, one order longer at every step
    share, whole_context = lower.copy(), np.zeros(n, np.int64)
    rows = np.arange(n)  # n-grams of at least m bytes
    ending, context = back[0], np.zeros(n, np.int64)
    contexts = 0
    for m in range(2, ORDER + 1):
        _, ending = np.unique(ending * 256 + back[m - 1][rows], return_inverse=True)
        _, context = np.unique(context * 256 + back[m - 1][rows], return_inverse=True)
        exact = length[rows] == m
        # Contexts of whole n-grams, numbered over all lengths.
        _, whole_context[rows[exact]] = np.unique(context[exact], return_inverse=True)
        whole_context[rows[exact]] += contexts
        contexts = whole_context[rows[exact]].max(initial=contexts - 1) + 1
        rows, ending, context = rows[~exact], ending[~exact], context[~exact]
        if not len(rows):
            break
        if m == 2:  # other bytes before the pair are in other tasks
            lower[rows] = pair[back[1][rows], back[0][rows]]
        else:
            # How many distinct bytes stand before each string of m bytes.
            longer = np.unique(ending * 256 + back[m][rows])
            before = np.bincount(longer >> 8).astype(np.float64)
            some = np.zeros(len(before), np.int64)
            some[ending] = context
            total = np.bincount(some, weights=before)
            kinds = np.bincount(some, weights=before > 0)
            lower[rows] = (np.maximum(before[ending] - DISCOUNT, 0) + DISCOUNT * kinds[context] * lower[rows]) / total[context]
        share[rows] = lower[rows]
    logs = []
    for count in (t, o):
        total = np.bincount(whole_context, weights=count, minlength=contexts)
        free = DISCOUNT * np.bincount(whole_context, weights=count > 0, minlength=contexts)
        free = np.where(total > 0, free / np.maximum(total, 1), 1.0)
        seen = total[whole_context]
        p = np.where(seen > 0, np.maximum(count - DISCOUNT, 0) / np.maximum(seen, 1), 0) + free[whole_context] * share
        logs.append((np.log(p), np.log(free)))
    whole = np.zeros(n, np.uint64)
    for i, b in enumerate(back):
        whole += np.where(b > 0, common.BYTE_VALUE[b] * np.uint64(pow(common.MULT, i + 1, 1 << 64)), 0).astype(np.uint64)
    keys, context_keys = _hashed(whole, common.BYTE_VALUE[back[0]], length - 1)
    first = np.zeros(contexts, np.int64)
    first[whole_context] = np.arange(n)
    begins = np.full(n, SHORT)
    for m in range(5, ORDER + 1):
        begins = np.where(length == m, np.where(back[m - 1] == 0x20, (back[m - 2] << 16) + (back[m - 3] << 8) + back[m - 4], INNER), begins)
    return (keys, (logs[0][0] - logs[1][0]).astype(np.float32), begins,
            context_keys[first], (logs[0][1] - logs[1][1]).astype(np.float32), begins[first])


def _estimated(counted: DataFrame) -> DataFrame:
    """(context, hash, number, begins) of all counted n-grams and of their contexts."""
    spark = counted.sparkSession
    # A row for each pair of bytes at most.
    pairs = (counted.select(F.col("tail").bitwiseAND(0xFFFFFF).alias("three")).distinct()
             .groupBy(F.col("three").bitwiseAND(0xFFFF).alias("pair")).agg(F.count_if(F.col("three") > 0xFFFF).alias("n")).toArrow())
    pair, before = pairs.column("pair").to_numpy(), np.zeros(1 << 16)
    before[pair] = pairs.column("n").to_numpy()
    single = single_bytes(pair)
    double = pair_bytes(before.reshape(256, 256), single)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        head, tail, t, o = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("head", "tail", "t", "o"))
        del held
        head, tail, t, o = _summed(head, tail, t, o)
        group = tail >> 8 & 0xFFFF
        order = np.argsort(group, kind="stable")
        ends = np.flatnonzero(np.diff(group[order], append=-1)) + 1
        at = 0
        while at < len(order):  # whole groups
            end = int(ends[min(np.searchsorted(ends, at + GROUP_ROWS), len(ends) - 1)])
            own = order[at:end]
            keys, values, begins, contexts, backoff, begun = estimate(
                head[own].view(np.uint64), tail[own].view(np.uint64), t[own].astype(np.float64), o[own].astype(np.float64), single, double)
            for is_context, hashes, numbers, first in ((False, keys, values, begins), (True, contexts, backoff, begun)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), is_context)), pa.array(hashes.view(np.int64)),
                                                  pa.array(numbers), pa.array(first.astype(np.int32))], ["context", "hash", "number", "begins"])
            at = end
    tasks = max(4 * spark.sparkContext.defaultParallelism, counted.count() // TASK_ROWS)
    return (counted.repartition(tasks, F.shiftright("tail", 8).bitwiseAND(0xFFFF))
            .mapInArrow(run, "context boolean, hash long, number float, begins int"))


def _arrays(tables: DataFrame) -> tuple[np.ndarray, ...]:
    """Sorted keys with values and sorted contexts with backoffs, of few n-grams."""
    return _sorted(tables.toArrow())


def _sorted(found: pa.Table) -> tuple[np.ndarray, ...]:
    out = []
    for is_context in (False, True):
        own = found.filter(pa.compute.equal(found.column("context"), is_context))
        hashes, numbers = own.column("hash").to_numpy().view(np.uint64), own.column("number").to_numpy()
        order = np.argsort(hashes)
        out += [hashes[order], numbers[order]]
    return tuple(out)


def _tables(counted: DataFrame) -> tuple[np.ndarray, ...]:
    return _arrays(_estimated(counted))


# -- what stands beside the blocks of documents ---------------------------------
def _located(docs: DataFrame, column: str) -> DataFrame:
    """``docs`` with the number of the block that each row belongs to.  Runs of rows of a
    file are dealt to the blocks; rows that come from no file are written to one."""
    names = docs.columns
    run = lambda d: d.select("*", F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / RUN_ROWS)).alias(column))
    try:
        rows = run(docs)
    except AnalysisException:
        inner = [f"c{i}" for i in range(len(names))]
        docs = materialize(docs.toDF(*inner), "documents").toDF(*names)
        rows = run(docs)
    blocks = docs.count() // BLOCK_ROWS + 1
    return rows.withColumn(column, F.pmod(F.col(column), F.lit(blocks)))


def _block_runs(batches: Iterator[pa.RecordBatch], block: str, text: str):
    """Block and run of documents, as ``each_run`` gives it, of each run of one block."""
    for batch in batches:
        ids = batch.column(block).to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
        for a, b in zip(cut, cut[1:], strict=False):
            for found in common.each_run([batch.slice(a, b - a)], text, RUN_BYTES):
                yield int(ids[a]), *found


def _put_beside(rows: DataFrame, purpose: str) -> str:
    """Writes (block, id, value) as one file per block, in the order of the ids."""
    folder = work_dir(rows.sparkSession, purpose)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def write(block: int, held: list) -> None:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            common.write_file(f"{folder}/{block}", [x.tobytes() for x in columns])
        now, held, n = None, [], 0
        for batch in batches:
            block, ids, value = (batch.column(c).to_numpy() for c in ("block", "id", "value"))
            cut = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(cut, cut[1:], strict=False):
                if b > a and block[a] != now:
                    if held:
                        write(now, held)
                    now, held, n = int(block[a]), [], n + 1
                held.append((ids[a:b], value[a:b]))
        if held:
            write(now, held)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])
    (rows.select("block", "id", "value").repartition("block").sortWithinPartitions("block", "id")
     .mapInArrow(run, "n long").agg(F.sum("n")).collect())
    return folder


class _Beside:
    """The files of ``_put_beside`` by block; the last one is kept."""

    def __init__(self, folder: str) -> None:
        self.folder, self.block, self.held = folder, None, None

    def look(self, block: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which ids are in the block's file, and their values."""
        if block != self.block:
            try:
                with common.open_file(f"{self.folder}/{block}") as f:
                    data = f.read()
            except FileNotFoundError:  # nothing stands beside this block
                data = b""
            n = len(data) // 16
            self.block, self.held = block, (np.frombuffer(data, np.int64, n), np.frombuffer(data, np.float64, n, 8 * n) if n else np.zeros(0))
        own, value = self.held
        if not len(own):
            return np.zeros(len(ids), bool), np.zeros(len(ids))
        at = np.minimum(np.searchsorted(own, ids), len(own) - 1)
        return own[at] == ids, value[at]


def _labelled(docs: DataFrame, labels: DataFrame):
    """A function that gives, for the number of a part, a function that leaves of batches of
    (doc_id, text, _block) the documents of that part, with their label as ``toxic``."""
    ids = docs.select("doc_id", F.col("_block").alias("block")).join(labels, "doc_id")
    folder = _put_beside(ids.select("block", F.col("doc_id").alias("id"), (F.col("toxic") + 2 * F.col("part")).cast("double").alias("value")), "labels")

    def of(part: int):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            beside = _Beside(folder)
            for batch in batches:
                block, ids = batch.column("_block").to_numpy(), batch.column("doc_id")
                known, ids = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
                toxic = np.zeros(len(block), np.int32)
                for b in np.unique(block):
                    own = np.flatnonzero(block == b)
                    seen, value = beside.look(int(b), ids[own])
                    known[own] &= seen & (value // 2 == part)
                    toxic[own] = value % 2
                keep = pa.array(np.flatnonzero(known))
                yield pa.RecordBatch.from_arrays([batch.column("text").take(keep), pa.array(toxic).take(keep), batch.column("_block").take(keep)],
                                                 ["text", "toxic", "_block"])
        return pick
    return of


def _word_scores(docs: DataFrame, tables: DataFrame, pick=iter) -> str:
    """Folder with a file of the scores of the distinct words of each block of (text,
    _block) rows that ``pick`` leaves, by the words' hashes.  Words meet the n-grams that begin like them; only n-grams
    inside long words are joined one by one."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, _, _, _, data, offsets in _block_runs(batches, "_block", "text"):
            starts, lengths, _, hashes = word_bytes(data, offsets)
            first = np.unique(hashes, return_index=True)[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), own, np.int32)), spelled(data, starts[first], lengths[first])], ["block", "word"])

    @common.released
    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged(each(pick(batches)), ["block", "word"], [])
    words = materialize(docs.mapInArrow(words_of, "block int, word binary")
                        .groupBy("word").agg(F.collect_set("block").alias("blocks")), "words")
    # These hold three bytes of a word at most, which bounds their number.
    sent = docs.sparkSession.sparkContext.broadcast(_arrays(tables.where(F.col("begins") == SHORT)))

    def score_of(words: pa.Table, entries: pa.Table) -> pa.Table:
        if not words.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.list_(pa.int32()), pa.float64())], ["id", "blocks", "value"])
        longer, out = _sorted(entries), []
        for a in range(0, words.num_rows, WORDS):
            data, starts, lengths = _word_column(words.column("word").slice(a, WORDS))
            word, key, context = ngram_keys(data, starts, lengths)
            at = _placed(starts, lengths)[3]
            value = np.zeros(len(word))
            for own, arrays in ((at < 3, sent.value), ((at >= 3) & (at < ORDER - 1), longer)):
                value[own] = _found(*arrays, key[own], context[own])
            out.append((_word_hashes(data, starts), np.bincount(word, weights=value, minlength=len(starts))))
        ids, value = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table([pa.array(ids), words.column("blocks"), pa.array(value)], ["id", "blocks", "value"])

    @common.released
    def inner_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            data, starts, lengths = _word_column(table.column("word"))
            word, key, context = ngram_keys(data, starts, lengths)
            own = _placed(starts, lengths)[3] >= ORDER - 1
            ids = _word_hashes(data, starts)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[word[own]], key[own].view(np.int64), context[own].view(np.int64))], ["id", "key", "begun"])
    dealt = lambda begins: (begins % BEGINNINGS).alias("begins")
    entries = tables.where(F.col("begins") >= 0).select(dealt(F.col("begins")), "context", "hash", "number")
    outer = (words.select(dealt(F.conv(F.hex(F.substring("word", 1, 3)), 16, 10).cast("int")), "word", "blocks").groupBy("begins").cogroup(entries.groupBy("begins"))
             .applyInArrow(score_of, "id long, blocks array<int>, value double"))
    own = lambda c, key, name: tables.where((F.col("context") == c) & (F.col("begins") == INNER)).select(
        F.col("hash").alias(key), F.col("number").cast("double").alias(name))
    inner = (words.where(F.length("word") >= ORDER - 1).select("word").mapInArrow(inner_of, "id long, key long, begun long")
             .join(own(False, "key", "seen"), "key", "left").join(own(True, "begun", "rest"), "begun", "left")
             .groupBy("id").agg(F.sum(F.coalesce("seen", "rest", F.lit(0.0))).alias("inner")))
    return _put_beside(outer.join(inner, "id", "left").select(
        F.explode("blocks").alias("block"), "id", (F.col("value") + F.coalesce("inner", F.lit(0.0))).alias("value")), "word-scores")


def _word_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of words that follow each other, as whole numbers; each is a document of its own."""
    return word_bytes(data, np.append(starts, len(data)))[3].view(np.int64)


def _found(keys: np.ndarray, values: np.ndarray, contexts: np.ndarray, backoff: np.ndarray, key: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Difference of n-grams by key, or of an unseen continuation by context, or zero."""
    out = np.zeros(len(key))
    for own, numbers, wanted in ((contexts, backoff, context), (keys, values, key)):
        if len(own):
            at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
            out = np.where(own[at] == wanted, numbers[at], out)
    return out


def evidence(beside: _Beside, block: int, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per document: difference per byte over all words, and over its TOP strongest words."""
    n = len(offsets) - 1
    out = np.zeros((n, 2))
    starts, lengths, doc, hashes = word_bytes(data, offsets)
    if not len(starts):
        return out
    distinct, which = np.unique(hashes, return_inverse=True)
    seen, own = beside.look(block, distinct.view(np.int64))
    if not seen.all():
        raise ValueError("the documents changed while they were scored")
    own = own[which]
    size = (lengths + 1).astype(np.float64)
    out[:, 0] = np.bincount(doc, weights=own, minlength=n) / np.maximum(np.bincount(doc, weights=size, minlength=n), 1)
    strong = np.lexsort((-own / size, doc))
    begin = np.searchsorted(doc[strong], np.arange(n))
    rank = np.arange(len(strong)) - begin[doc[strong]]
    top = strong[rank < TOP]
    out[:, 1] = np.bincount(doc[top], weights=own[top], minlength=n) / np.maximum(np.bincount(doc[top], weights=size[top], minlength=n), 1)
    return out


def calibrate(rows: DataFrame, weight: dict[int, float]) -> np.ndarray:
    """Logistic regression of ``toxic`` on (whole, top) by Newton steps with a small ridge,
    with a weight for each class; the last weight is the constant.  Sums are of decimals,
    so the order of the rows does not matter."""
    z = [F.col("whole"), F.col("top"), F.lit(1.0)]
    each = F.when(F.col("toxic") == 1, F.lit(float(weight[1]))).otherwise(F.lit(float(weight[0])))
    w = np.zeros(len(z))
    for _ in range(40):
        at = sum(F.lit(float(a)) * c for a, c in zip(w, z, strict=True))
        p = 1 / (1 + F.exp(-F.least(F.greatest(at, F.lit(-30.0)), F.lit(30.0))))
        inner = rows.select(*[c.alias(f"z{i}") for i, c in enumerate(z)], (each * p * (1 - p)).alias("h"), (each * (F.col("toxic") - p)).alias("g"))
        terms = [F.col("h") * F.col(f"z{i}") * F.col(f"z{j}") for i in range(3) for j in range(3)] + [F.col("g") * F.col(f"z{i}") for i in range(3)]
        sums = np.array([float(x) for x in inner.agg(*[F.sum(x.cast("decimal(28,14)")) for x in terms]).first()])
        step = np.linalg.solve(sums[:9].reshape(3, 3) + 1e-2 * np.eye(3), sums[9:] - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def remainder(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4, F.lit(-1))


def _sample(labels: DataFrame, per_class: int) -> DataFrame:
    one = lambda k: labels.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    return one(1).unionAll(one(0))


def _texts(docs: DataFrame, chosen: DataFrame, class_bytes: int) -> DataFrame:
    """Texts of the chosen labelled ids; they are few, so they are sent to the documents.
    In the order of the sample an id takes part while those of its class before it have
    fewer than ``class_bytes`` bytes."""
    own = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    size = own.groupBy("doc_id", "toxic").agg(F.sum(F.octet_length("text")).alias("size"))
    before = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    kept = materialize(size.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
                       .where(F.col("before") < class_bytes).select("doc_id", "toxic"), "sample")
    return docs.select("doc_id", "text").join(F.broadcast(kept), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, per_class: int | None = None, class_bytes: int | None = None) -> Model:
    """Both models and the calibration from all labelled rows (doc_id, toxic); three
    quarters of those given, by a second hash of the id, are for the counts and the rest
    for the calibration.  No query bounds them; a caller that names ``per_class`` and
    ``class_bytes`` has so many documents, and about so many bytes, of each class and part."""
    common.small_batches(docs.sparkSession)
    labels = _parts(labels)
    docs = _located(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "_block")
    if per_class is not None and class_bytes is not None:
        few = [_texts(docs, _sample(labels.where(F.col("part") == i), per_class), class_bytes).select("doc_id") for i in (0, 1)]
        labels = labels.join(few[0].unionAll(few[1]).distinct(), "doc_id")
    part = _labelled(docs, labels)
    tables = _learned(docs, part(0))
    if tables is None:
        return Model(None, np.zeros(3))
    folder = _word_scores(docs, tables, part(1))
    return Model(tables, _weights(docs, part(1), folder, labels))


def _parts(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic, part) of each labelled id; part 0 is counted, part 1 calibrates."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
            .withColumn("part", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 3).cast("int")))


def _learned(docs: DataFrame, pick) -> DataFrame | None:
    """The tables of the documents that ``pick`` leaves, if there are words of both classes."""
    counted = materialize(_count(docs, pick), "ngrams")
    seen = counted.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    return materialize(_estimated(counted), "tables") if seen.t and seen.o else None


def _weights(docs: DataFrame, pick, folder: str, labels: DataFrame) -> np.ndarray:
    """The calibration on the labelled documents that were not counted."""
    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        beside = _Beside(folder)
        for block, batch, a, b, data, offsets in _block_runs(pick(batches), "_block", "text"):
            e = evidence(beside, block, data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(a, b - a), pa.array(e[:, 0]), pa.array(e[:, 1])], ["toxic", "whole", "top"])
    rows = materialize(docs.mapInArrow(run, "toxic int, whole double, top double"), "evidence")
    share, number = ({r.toxic: r["count"] for r in x.groupBy("toxic").count().collect()} for x in (labels.where("part = 1"), rows))
    return calibrate(rows, {k: share[k] / number[k] for k in number}) if len(number) == 2 else np.array([10.0, 10.0, -10.0])


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in ``column``."""
    if model.tables is None:
        return docs.select("*", F.lit(0.0).alias(column))
    common.small_batches(docs.sparkSession)
    located, block = _with_block(docs)
    return _scored(located, block, _word_scores(_plain(located, block), model.tables), model.weights, column)


def fit_score(docs: DataFrame, labels: DataFrame, column: str = "score") -> DataFrame:
    """``score`` of the documents that ``fit`` learned from; words are looked up once."""
    common.small_batches(docs.sparkSession)
    labels = _parts(labels)
    located, block = _with_block(docs)
    rows = _plain(located, block, F.col("doc_id").cast("long").alias("doc_id"))
    part = _labelled(rows, labels)
    tables = _learned(rows, part(0))
    if tables is None:
        return docs.select("*", F.lit(0.0).alias(column))
    folder = _word_scores(_plain(located, block), tables)
    return _scored(located, block, folder, _weights(rows, part(1), folder, labels), column)


def _plain(located: DataFrame, block: str, *more: Column) -> DataFrame:
    return located.select(*more, "text", F.col(block).alias("_block"))


def _with_block(docs: DataFrame) -> tuple[DataFrame, str]:
    block = "_block" + "_" * max(map(len, docs.columns), default=0)  # longer than any name
    return _located(docs, block), block


def _scored(located: DataFrame, block: str, folder: str, weights: np.ndarray, column: str) -> DataFrame:
    model, names = Model(None, weights), located.columns[:-1]

    def made(name):
        @common.released
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            beside = _Beside(folder)
            for own, batch, a, b, data, offsets in _block_runs(batches, name(block), name("text")):
                yield common.with_columns(batch.slice(a, b - a), pa.array(model.score(evidence(beside, own, data, offsets))))
        return run
    scored = common.extended(located, made, **{column: "double"})
    return scored.toDF(*[f"c{i}" for i in range(len(names))], "block", "score").drop("block").toDF(*names, column)
