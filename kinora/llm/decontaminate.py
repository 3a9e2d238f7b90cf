"""Documents that hold a benchmark item, by edit distance over words.

An item is held if some passage of the document is within ``floor(n * (100 - least) /
100)`` word edits of its n words.

1. A CGK random walk embeds item-sized windows: at step j the current word is written
   and the walk moves on or not by a random bit of (repetition, j, word), so strings at
   a small edit distance get embeddings at a small Hamming distance.
2. Each of ``REPEATS`` walks is sampled ``SAMPLES`` times at ``BITS`` positions; a
   window is a candidate if any of these keys equals the item's.  The tests measure a
   recall above 0.97 at the largest edit distance allowed, and 1 for exact copies.
3. Candidates are verified by the exact edit distance of the item to any part of the
   window, widened by the edits allowed.

Items that allow no edit, as short ones do, need no walk: their words' hash is looked up
among the runs of as many words, and the words are compared.

Windows start where they can match at all: of n words with e edits at least one run of
``ceil((n - e) / (e + 1))`` stays whole, so the window of a match shares one of the
item's runs of two or three words, at a place that fixes the window.  Nothing is lost
by leaving out the other places.

The benchmark is sent to the tasks in blocks of ``block_words`` words: one for the usual
sizes, else the documents are read once for each block.

Cases: null and empty texts hold nothing; an item of fewer than ``min_words`` words, or
a null one, is not searched (with ``min_words`` 1 only items without words are left out); repeated items are separate
items; an empty benchmark or table works; all columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.session import materialize

REPEATS, SAMPLES, BITS = 10, 6, 2
#: Windows embedded at a time.
WINDOWS = 4096
_FILTER_BITS = 22


class Items:
    """One block of benchmark items: words, runs that seed windows, and keys."""

    def __init__(self, ids: list[int], texts: list[str], least: int, min_words: int) -> None:
        data, offsets = common.utf8(pa.array(texts, pa.string()))
        hashes, doc = common.words(data, offsets)
        counts = np.bincount(doc, minlength=len(texts))
        kept = np.flatnonzero(counts >= min_words)
        self.ids = np.array(ids, np.int64)[kept]
        cut = np.cumsum(counts) - counts
        self.words = [hashes[cut[i]:cut[i] + counts[i]] for i in kept]
        self.n = counts[kept]
        self.edits = self.n * (100 - least) // 100
        run = np.minimum(-(-(self.n - self.edits) // (self.edits + 1)), 3)
        self.seeds, self.exact = {}, {}
        for g in np.unique(self.n[self.edits == 0]).tolist():
            own = np.flatnonzero((self.n == g) & (self.edits == 0))
            whole = np.concatenate([common.grams(self.words[i], np.zeros(g, np.int64), g)[0] for i in own])
            order = np.argsort(whole, kind="stable")
            self.exact[g] = (whole[order], own[order], np.array([self.words[i] for i in own[order]]))
        for g in np.unique(run[self.edits > 0]).tolist():
            own = [(common.grams(self.words[i], np.zeros(self.n[i], np.int64), g)[0], i) for i in np.flatnonzero((run == g) & (self.edits > 0))]
            seed = np.concatenate([s for s, _ in own])
            item = np.concatenate([np.full(len(s), i) for s, i in own])
            at = np.concatenate([np.arange(len(s)) for s, _ in own])
            order = np.argsort(seed, kind="stable")
            maybe = np.zeros(1 << _FILTER_BITS, bool)
            maybe[(seed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.seeds[g] = (seed[order], item[order], at[order], maybe)
        rng = np.random.default_rng(11)
        # Where samples are taken, as shares of the walk; it takes about two steps a word.
        self.share = rng.uniform(0, 1.8, (REPEATS, SAMPLES, BITS))
        if len(self.n):
            every, start = np.concatenate(self.words), np.cumsum(self.n) - self.n
            self.keys = self.embed(every, start, start + self.n, np.arange(len(self.n)))

    def embed(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Sampled keys (window, repeat, sample) of the windows of the items' sizes."""
        n = self.n[item]
        stop = np.minimum(start + n, end)
        steps = int(np.ceil(1.8 * n.max())) + 1
        keys = np.zeros((len(start), REPEATS, SAMPLES), np.uint64)
        written = np.zeros((steps, len(start)), np.uint64)
        for r in range(REPEATS):
            at = start.copy()
            for j in range(steps):
                word = np.where(at < stop, hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
                written[j] = word
                salt = np.uint64((0x2545F4914F6CDD1D * (r * 65537 + j + 1)) % (1 << 64))
                at += (common.mix(word ^ salt) >> np.uint64(63)).astype(np.int64)
            for s in range(SAMPLES):
                for b in range(BITS):
                    place = (self.share[r, s, b] * n).astype(np.int64)
                    keys[:, r, s] = keys[:, r, s] * np.uint64(common.MULT) + written[place, np.arange(len(start))]
        return keys

    def windows(self, hashes: np.ndarray, doc: np.ndarray):
        """(first word, item) of each window that a run of an item's words fixes."""
        starts, items = [], []
        for g, (seed, item, at, maybe) in self.seeds.items():
            gram, of, place = common.grams(hashes, doc, g)
            hit = np.flatnonzero(maybe[(gram >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            low, high = np.searchsorted(seed, gram[hit], "left"), np.searchsorted(seed, gram[hit], "right")
            count = high - low
            pick = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            first = np.searchsorted(doc, of[hit])  # the document's first word
            starts.append(np.maximum(np.repeat(place[hit], count) - at[pick], np.repeat(first, count)))
            items.append(item[pick])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate(starts), np.concatenate(items)], axis=1), axis=0)
        return both[:, 0], both[:, 1]

    def held(self, hashes: np.ndarray, doc: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) of each item that a document of one run holds."""
        out: set[tuple[int, int]] = set()
        if not len(self.n) or not len(hashes):
            return out
        for g, (whole, own, spelled) in self.exact.items():
            gram, of, place = common.grams(hashes, doc, g)
            low, high = np.searchsorted(whole, gram, "left"), np.searchsorted(whole, gram, "right")
            for t in range(int((high - low).max(initial=0))):  # items of the same words
                hit = np.flatnonzero(low + t < high)
                pick = low[hit] + t
                same = (hashes[place[hit][:, None] + np.arange(g)] == spelled[pick]).all(axis=1)
                out.update(zip(of[hit[same]].tolist(), own[pick[same]].tolist(), strict=True))
        start, item = self.windows(hashes, doc)
        for a in range(0, len(start), WINDOWS):
            s, i = start[a:a + WINDOWS], item[a:a + WINDOWS]
            end = np.searchsorted(doc, doc[s], "right")
            near = np.flatnonzero((self.embed(hashes, s, end, i) == self.keys[i]).any(axis=(1, 2)))
            for k in np.unique(i[near]).tolist():
                own = near[i[near] == k]
                ok = own[self._distance(hashes, doc, s[own], end[own], k) <= self.edits[k]]
                out.update((int(d), k) for d in doc[s[ok]])
        return out

    def _distance(self, hashes: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        """Least edit distance of item k to any part of each window widened by its edits."""
        e, n = int(self.edits[k]), int(self.n[k])
        low = np.maximum(start - e, np.searchsorted(doc, doc[start]))
        place = low[:, None] + np.arange(n + 3 * e + 1)
        text = np.where(place < end[:, None], hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0))
        step = np.arange(text.shape[1] + 1)
        row = np.zeros((len(start), text.shape[1] + 1), np.int64)  # a match may begin anywhere
        for i, word in enumerate(self.words[k]):
            new = np.empty_like(row)
            new[:, 0] = i + 1
            new[:, 1:] = np.minimum(row[:, :-1] + (text != word), row[:, 1:] + 1)
            row = np.minimum.accumulate(new - step, axis=1) + step
        return row.min(axis=1)


def flag(docs: DataFrame, benchmark: DataFrame, column: str = "items", least: int = 80, min_words: int = 5,
         block_words: int = 2_000_000) -> DataFrame:
    """``docs`` with the ids of the items that each row's whole text holds, in ascending
    order (empty: none), in ``column``."""
    spark = docs.sparkSession
    common.small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // (5 * block_words)))
    out, earlier = docs, f"{column} before"
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        sent = spark.sparkContext.broadcast(Items([r.item_id for r in own], [r.text for r in own], least, min_words))

        def made(name, sent=sent):
            @common.released
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch, a, b, data, offsets in common.each_run(batches, name("text")):
                    found: list[set[int]] = [set() for _ in range(b - a)]
                    for d, k in sent.value.held(*common.words(data, offsets)):
                        found[d].add(int(sent.value.ids[k]))
                    yield common.with_columns(batch.slice(a, b - a), pa.array([sorted(x) for x in found], pa.list_(pa.int64())))
            return run
        if not block:
            out = common.extended(docs, made, **{column: "array<bigint>"})
        else:  # the documents are read once more, from what the block before wrote
            rest = common.quoted(column)
            out = common.extended(materialize(out.withColumnRenamed(column, earlier), "decontaminated"), made, **{column: "array<bigint>"})
            out = out.withColumn(column, F.array_sort(F.array_union(rest, common.quoted(earlier)))).drop(earlier)
    return out
