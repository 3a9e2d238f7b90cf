"""Conversation prefix trie, by double arrays per prefix shard.

1. Turns are numbered within their conversation: a range partitioning by conversation,
   turn and digest sorts them, tasks number their own part, and counts per task and
   conversation give the offsets, so one very long conversation is no single task's.
2. Conversations are rebuilt (``rebuilt``) and cut into segments of ``SEGMENT`` turns.  A
   segment's context is a 128-bit digest of all turns before it, and equal segments of
   one context are one class with a count and its smallest conversation.
3. Classes are range-partitioned by context and first turns: a shard of prefixes is even
   however common a first turn is.  A task packs bounded runs of classes into a double
   array (``DoubleArray``: BASE and CHECK over dense turn ids), walks it for the nodes and
   gives each node's members; nodes that several runs share, the upper ones, are merged
   globally by their prefix digest.
4. A conversation owns the nodes of which it is the smallest member: those of its path
   from some depth on.  The tokens saved below a node are then a sum over its members,
   the words of turns from the node's depth up to where the member begins to own, and its
   leaves are its members that own a childless node.  So a second walk over the same
   double arrays adds up both per node, and again the upper nodes are merged globally: no
   step goes level by level.
5. Conversations that end at a node are hashed in order: tasks join bounded runs of ids,
   one stream per node hashes the runs.

Cases: a null role or text is empty; rows of a null conv_id belong to no conversation;
turns of equal number are ordered by the digest of role and text, so repeated rows stay
as repeated turns; a conversation that rebuilds to no turns is a member of the root and
ends there; an empty table gives no rows; further columns are ignored.  Turns and
prefixes are compared by 120-bit and 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.session import materialize

#: Turns of a segment, which bounds a row.
SEGMENT = 64
#: Turns packed into one double array.
PACKED = 1 << 18
#: Ids joined as one run for hashing.
IDS = 4096
ROLES = 20
SPACE = r"[\x20\x09-\x0D]+"


# -- turns and rebuilt conversations --------------------------------------------
def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, part, at (from 0 within conversation and part), k1, k2, words of each turn."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    digest = F.md5(F.encode(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), digest.alias("digest"),
                                                              F.size(F.array_remove(F.split(text, SPACE, -1), "")).cast("long").alias("words"))
    rows = rows.select("conv_id", "turn", F.conv(F.substring("digest", 1, 15), 16, 10).cast("long").alias("k1"),
                       F.conv(F.substring("digest", 16, 15), 16, 10).cast("long").alias("k2"), "words")
    rows = materialize(rows, "digests")  # the range exchange reads its input twice: not the texts
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("k1"), F.asc("k2")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim(None)
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column("conv_id").to_numpy()
            if not len(ids):
                continue
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            at = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
            if ids[0] == last:
                at[:first[1] if len(first) > 1 else None] += n
            last, n = ids[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(np.full(len(ids), part)), pa.array(at),
                                              *(batch.column(c) for c in ("k1", "k2", "words"))], ["conv_id", "part", "at", "k1", "k2", "words"])
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(run, "conv_id long, part long, at long, k1 long, k2 long, words long"))


def rebuilt(turns: DataFrame, every: int = ROLES) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, k1, k2, words of the rebuilt turns; conv_id, length).

    With h the crc32 of the decimal conv_id modulo 4, a conversation is the first h turns
    of conversation ``conv_id - conv_id % every`` and its own after its first h."""
    runs = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part")
    runs = materialize(runs.select("conv_id", "part", F.coalesce(F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
                                   F.sum("n").over(Window.partitionBy("conv_id")).alias("length"),
                                   (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % 4).alias("h"),
                                   (F.col("conv_id") - F.col("conv_id") % every).alias("base")), "runs")
    bases = runs.where(f"offset = 0 and conv_id % {every} = 0").select(F.col("conv_id").alias("base"), F.col("length").alias("has"))
    taken = F.least("h", F.coalesce("has", F.lit(0)))
    runs = runs.join(bases, "base", "left").withColumn("taken", taken)
    # A part holds a bounded share of a conversation, so this key is even.
    placed = turns.join(runs.select("conv_id", "part", "offset", "h", "taken"), ["conv_id", "part"]).select(
        "conv_id", (F.col("at") + F.col("offset") + 1).alias("pos"), "h", "taken", "k1", "k2", "words")
    placed = materialize(placed, "placed")
    convs = runs.where("offset = 0").select("conv_id", "base", "h", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length"))
    heads = placed.where(f"pos <= 3 and conv_id % {every} = 0").select(F.col("conv_id").alias("base"), "pos", "k1", "k2", "words")
    copied = convs.join(heads, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "k1", "k2", "words")
    own = placed.where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "k1", "k2", "words")
    return own.unionAll(copied), convs.select("conv_id", "length")


# -- digests ----------------------------------------------------------------------
_LANES = (np.uint64(common.MULT), np.uint64(0xD6E8FEB86659FD93))


def _chains(k1: np.ndarray, k2: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Per turn of flat sequences two running digests of its sequence up to it."""
    keys, out = (k1.view(np.uint64), k2.view(np.uint64)), [np.zeros(len(k1), np.uint64) for _ in _LANES]
    state = [np.zeros(len(starts), np.uint64) for _ in _LANES]
    for d in range(int(lengths.max(initial=0))):
        alive = np.flatnonzero(lengths > d)
        at = starts[alive] + d
        for lane, m in enumerate(_LANES):
            x = common.mix((state[lane][alive] + keys[0][at]) * m + np.uint64(d + 1))
            state[lane][alive] = out[lane][at] = common.mix((x ^ keys[1][at]) * m)
    return out


def _marked(chain: np.ndarray, lane: int, segment: np.ndarray) -> np.ndarray:
    """A running digest bound to its segment's number; contexts are xors of these."""
    return common.mix(chain ^ common.mix((segment.astype(np.uint64) + np.uint64(1)) * _LANES[1 - lane]))


class Rows:
    """Flat arrays of the turns of one batch of segments."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        keys = batch.column("keys")
        self.lengths = pc.list_value_length(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        flat = keys.flatten()
        self.k1, self.k2, self.words = (flat.field(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))


def segments(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """conv_id, seg, keys, c1, c2 (context), s1, s2 (this segment's share of the next
    one's context), more (whether another segment follows)."""
    rows = turns.withColumn("seg", F.floor((F.col("depth") - 1) / size)).groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("depth", "k1", "k2", "words"))).alias("keys"))  # at most `size` turns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim(None)
        for batch in batches:
            r = Rows(batch)
            chains = _chains(r.k1, r.k2, r.starts, r.lengths)
            seg = batch.column("seg").to_numpy()
            marks = [pa.array(_marked(c[r.starts + r.lengths - 1], lane, seg).view(np.int64)) for lane, c in enumerate(chains)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "seg", "keys")), *marks], ["conv_id", "seg", "keys", "s1", "s2"])
    kind = "conv_id long, seg long, keys array<struct<depth:long,k1:long,k2:long,words:long>>"
    rows = materialize(rows.select("conv_id", "seg", "keys").mapInArrow(run, f"{kind}, s1 long, s2 long"), "segments")
    # Conversations of several segments: a window over few and narrow rows.
    path = Window.partitionBy("conv_id").orderBy("seg")
    before = path.rowsBetween(Window.unboundedPreceding, -1)
    long = rows.where((F.col("seg") > 0) | (F.size("keys") == size)).select(
        "conv_id", "seg", F.bit_xor("s1").over(before).alias("c1"), F.bit_xor("s2").over(before).alias("c2"), F.lead("seg").over(path).isNotNull().alias("more"))
    zero = F.lit(0).cast("long")
    return rows.join(long, ["conv_id", "seg"], "left").select(
        "conv_id", "seg", "keys", F.coalesce("c1", zero).alias("c1"), F.coalesce("c2", zero).alias("c2"), "s1", "s2", F.coalesce("more", F.lit(False)).alias("more"))


# -- the double array ---------------------------------------------------------------
class DoubleArray:
    """Trie of sequences over dense codes: the child of slot s by code c is the slot
    ``base[s] + c``, if ``check`` there is s.  Slot 0 is the root."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        size = max(16, 2 * len(codes))
        self.base, self.check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.check[0] = 0
        self._first = 1  # no slot before is free
        self._top = 1  # no slot from here on is taken
        span, state = int(codes.max(initial=0)) + 1, np.zeros(len(starts), np.int64)
        for d in range(int(lengths.max(initial=0))):
            alive = np.flatnonzero(lengths > d)
            edges, which = np.unique(state[alive] * span + codes[starts[alive] + d], return_inverse=True)
            state[alive] = self._pack(edges // span, edges % span)[which]

    def _room(self, upto: int) -> None:
        if upto > len(self.check):
            more = max(upto, 2 * len(self.check)) - len(self.check)
            self.base, self.check = np.append(self.base, np.zeros(more, np.int64)), np.append(self.check, np.full(more, -1, np.int64))

    def _pack(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Slots for edges sorted by parent and code: first the nodes of several children,
        by first fit, then those of one child fill what is free."""
        begin = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        end = np.append(begin[1:], len(parent))
        slots = np.zeros(len(parent), np.int64)
        for a, b in zip(begin[end - begin > 1].tolist(), end[end - begin > 1].tolist(), strict=True):
            away = code[a:b] - code[a]
            self._room(self._top + int(away[-1]) + 1)
            free = np.flatnonzero(self.check[self._first:self._top] < 0)[:32] + self._first
            fits = [f for f in free.tolist() if f + int(away[-1]) < len(self.check) and (self.check[f + away] < 0).all()]
            slots[a:b] = (fits[0] if fits else self._top) + away
            self._take(slots[a:b], parent[a:b])
            self.base[parent[a]] = slots[a] - code[a]
        one = begin[end - begin == 1]
        if len(one):
            free = np.flatnonzero(self.check[self._first:self._top] < 0)[:len(one)] + self._first
            self._room(self._top + len(one))
            slots[one] = np.concatenate([free, np.arange(self._top, self._top + len(one) - len(free))])
            self._take(slots[one], parent[one])
            self.base[parent[one]] = slots[one] - code[one]
        return slots

    def _take(self, slots: np.ndarray, parent: np.ndarray) -> None:
        self.check[slots] = parent
        self._top = max(self._top, int(slots[-1]) + 1, int(slots.max()) + 1)
        while self._first < self._top and self.check[self._first] >= 0:
            gap = np.flatnonzero(self.check[self._first:self._first + 4096] < 0)
            self._first += int(gap[0]) if len(gap) else 4096
        self._first = min(self._first, self._top)

    def walk(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The slot of every element of the sequences; -1 from where one leaves the trie."""
        state, out = np.zeros(len(starts), np.int64), np.full(len(codes), -1, np.int64)
        for d in range(int(lengths.max(initial=0))):
            alive = np.flatnonzero((lengths > d) & (state >= 0))
            at = starts[alive] + d
            to = self.base[state[alive]] + codes[at]
            inside = (to >= 0) & (to < len(self.check))
            found = inside & (self.check[np.where(inside, to, 0)] == state[alive]) & (to != 0)
            state[alive] = out[at] = np.where(found, to, -1)
        return out


def dense(first: np.ndarray, second: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Numbers from 0 for pairs of keys, by their first appearance in ``order``: siblings
    get near numbers, so that double arrays stay dense."""
    pairs = np.stack([first[order], second[order]], axis=1)
    _, where, which = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
    rank = np.empty(len(where), np.int64)
    rank[np.argsort(where)] = np.arange(len(where))
    out = np.empty(len(order), np.int64)
    out[order] = rank[which.reshape(-1)]
    return out


class Packed:
    """A run of classes as a double array, and the slot of each of their turns."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        parts = [Rows(b) for b in batches]
        self.columns = {c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in batches]) for c in batches[0].schema.names if c != "keys"}
        self.lengths = np.concatenate([p.lengths for p in parts])
        self.starts = np.cumsum(self.lengths) - self.lengths
        k1, k2, self.words = (np.concatenate([getattr(p, c) for p in parts]) for c in ("k1", "k2", "words"))
        self.row = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.place = np.arange(len(self.row)) - self.starts[self.row]  # from 0 in the segment
        context = [self.columns[c].view(np.uint64) for c in ("c1", "c2")]
        marks = [_marked(c, lane, self.columns["seg"][self.row]) for lane, c in enumerate(_chains(k1, k2, self.starts, self.lengths))]
        self.keys = [m ^ c[self.row] for m, c in zip(marks, context, strict=True)]
        self.parents = [np.where(self.place > 0, np.roll(k, 1), c[self.row]) for k, c in zip(self.keys, context, strict=True)]
        # A context is a first code before the turns: one trie holds many contexts.
        heads = self.starts + np.arange(len(self.starts))
        at = np.arange(len(self.row)) + self.row + 1
        first, second, tag = np.zeros((3, len(self.row) + len(heads)), np.int64)
        first[at], second[at], first[heads], second[heads] = k1, k2, self.columns["c1"], self.columns["c2"]
        tag[heads], tag[at] = -1, self.place
        codes = dense(first ^ (tag < 0), second, np.argsort(tag, kind="stable"))
        self.trie = DoubleArray(codes, heads, self.lengths + 1)
        self.slots = self.trie.walk(codes, heads, self.lengths + 1)[at]

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """(the first turn of each node's slot, the node number of every turn)."""
        _, first, node = np.unique(self.slots, return_index=True, return_inverse=True)
        return first, node.reshape(-1)


def _packed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Packed]:
    """Bounded runs of a task's classes."""
    common.claim(None)
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += len(batch.column("keys").flatten())
        if n >= most:
            yield Packed(held)
            held, n = [], 0
    if held:
        yield Packed(held)


def _sharded(classes: DataFrame) -> DataFrame:
    """Classes by context and first turns, in even shards."""
    order = ["c1", "c2", *(F.get(F.col("keys"), F.lit(i))["k1"] for i in range(3)), "s1"]
    return classes.repartitionByRange(*order).sortWithinPartitions(*order)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def members(classes: DataFrame, size: int, most: int) -> DataFrame:
    """key1, key2, up1, up2, depth, conv_id, n_convs, words of every node below the root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _packed(batches, most):
            first, node = p.nodes()
            n, low = np.zeros(len(first), np.int64), np.full(len(first), np.iinfo(np.int64).max)
            np.add.at(n, node, p.columns["n"][p.row])
            np.minimum.at(low, node, p.columns["m"][p.row])
            depth = p.columns["seg"][p.row[first]] * size + p.place[first] + 1
            yield pa.RecordBatch.from_arrays([*(_signed(k[first]) for k in (*p.keys, *p.parents)), pa.array(depth), pa.array(low), pa.array(n), pa.array(p.words[first])],
                                             ["key1", "key2", "up1", "up2", "depth", "conv_id", "n_convs", "words"])
    found = _sharded(classes.select("c1", "c2", "seg", "s1", "keys", "n", "m")).mapInArrow(
        run, "key1 long, key2 long, up1 long, up2 long, depth long, conv_id long, n_convs long, words long")
    return found.groupBy("key1", "key2").agg(*[F.min(c).alias(c) for c in ("up1", "up2", "depth", "conv_id", "words")], F.sum("n_convs").alias("n_convs"))


def below(classes: DataFrame, size: int, most: int) -> DataFrame:
    """key1, key2, depth, n_leaves, saved_tokens: sums over the members of every node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _packed(batches, most):
            first, node = p.nodes()
            c, row = p.columns, p.row
            total = np.append(0, np.cumsum(p.words))
            rest = total[(p.starts + p.lengths)[row]] - total[:-1]  # words from this turn to the segment's end
            # How many turns of the segment its smallest conversation does not own.
            foreign = np.clip(c["owns"] - 1 - c["seg"] * size, 0, p.lengths)
            mine = np.maximum(total[(p.starts + foreign)[row]] - total[:-1], 0)
            saved, leaves = np.zeros((2, len(first)), np.int64)
            np.add.at(saved, node, (c["n"] - 1)[row] * rest + mine + c["later"][row])
            np.add.at(leaves, node, c["leaves"][row])
            depth = c["seg"][row[first]] * size + p.place[first] + 1
            yield pa.RecordBatch.from_arrays([*(_signed(k[first]) for k in p.keys), pa.array(depth), pa.array(leaves), pa.array(saved)],
                                             ["key1", "key2", "depth", "n_leaves", "saved_tokens"])
    found = _sharded(classes).mapInArrow(run, "key1 long, key2 long, depth long, n_leaves long, saved_tokens long")
    return found.groupBy("key1", "key2").agg(F.min("depth").alias("depth"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


# -- conversations that end at a node -------------------------------------------------
def end_digests(ends: DataFrame, run_ids: int = IDS) -> DataFrame:
    """key1, key2, ends_sha256 of (key1, key2, conv_id)."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim(None)
        for batch in batches:
            k1, k2, ids = (batch.column(c).to_numpy() for c in ("key1", "key2", "conv_id"))
            new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]) if len(ids) else np.zeros(0, bool)
            starts = np.flatnonzero(new)
            cuts = sorted({*starts.tolist(), *(i for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)], strict=True) for i in range(a, b, run_ids))})
            spans = list(zip(cuts, [*cuts[1:], len(ids)], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(ids[cuts]), pa.array([",".join(map(str, ids[a:b].tolist())) for a, b in spans], pa.string())],
                                             ["key1", "key2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim(None)
        key, state, done = None, None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.string())],
                                              ["key1", "key2", "ends_sha256"])
        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("key1", "key2", "ids")), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield out()
            done = []
        if key is not None:
            done.append((*key, state.hexdigest()))
            yield out()

    order = ["key1", "key2", "conv_id"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "key1 long, key2 long, first long, ids string")
    return runs.repartition("key1", "key2").sortWithinPartitions("key1", "key2", "first").mapInArrow(digest, "key1 long, key2 long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, every: int = ROLES, size: int = SEGMENT, most: int = PACKED, run_ids: int = IDS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    spark = conversations.sparkSession
    common.small_batches(spark)
    turns, convs = rebuilt(materialize(numbered(conversations), "turns"), every)
    convs = materialize(convs, "conversations")
    segs = materialize(segments(turns, size), "contexts")
    one = ["c1", "c2", "seg", "s1", "s2"]
    classes = materialize(segs.groupBy(*one).agg(F.first("keys").alias("keys"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("m")), "classes")

    merged = materialize(members(classes, size, most), "nodes")
    children = merged.groupBy(F.col("up1").alias("key1"), F.col("up2").alias("key2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = materialize(merged.join(children, ["key1", "key2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")

    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("owns"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    owned = segs.join(owners, "conv_id", "left")
    never = F.coalesce("owns", F.lit(1 << 62))
    shared = F.aggregate(F.filter("keys", lambda k: k["depth"] < never), F.lit(0).cast("long"), lambda a, k: a + k["words"])
    after = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    later = (owned.where("seg > 0 or more").select("conv_id", "seg", shared.alias("shared"))
             .select("conv_id", "seg", F.coalesce(F.sum("shared").over(after), F.lit(0)).alias("later")))
    sums = owned.join(later, ["conv_id", "seg"], "left").groupBy(*one).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).cast("long").alias("leaves"), F.sum(F.coalesce("later", F.lit(0))).cast("long").alias("later"),
        F.min(F.struct("conv_id", never.alias("owns"))).alias("least"))
    second = materialize(classes.join(sums, one).select("c1", "c2", "seg", "s1", "keys", "n", F.col("least.owns").alias("owns"), "leaves", "later"), "members")
    under = materialize(below(second, size, most), "below")

    last = segs.where(~F.col("more")).select(F.col("c1").bitwiseXOR(F.col("s1")).alias("key1"), F.col("c2").bitwiseXOR(F.col("s2")).alias("key2"), "conv_id")
    zero = F.lit(0).cast("long")
    ends = end_digests(last.unionAll(convs.where("length = 0").select(zero.alias("key1"), zero.alias("key2"), "conv_id")), run_ids)

    n, low = convs.agg(F.count(F.lit(1)), F.min("conv_id")).first()  # two numbers: the root's members
    none = F.lit(None).cast("long")
    top = under.where("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    top = top.where(F.lit(n > 0)).select(zero.alias("key1"), zero.alias("key2"), F.lit(low).cast("long").alias("conv_id"), zero.alias("depth"), none.alias("parent_conv_id"),
                                         F.lit(n).cast("long").alias("n_convs"), "n_children", F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", zero).alias("saved_tokens"))
    # Children of the root need no join; a node of very many children is split by adaptive execution.
    names = nodes.select(F.col("key1").alias("up1"), F.col("key2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    upper = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(low).cast("long"))
    lower = nodes.where("depth > 1").join(names, ["up1", "up2"], "left").select(*upper.columns)
    rows = upper.unionAll(lower).join(under.drop("depth"), ["key1", "key2"]).select(*top.columns).unionAll(top)
    empty = hashlib.sha256(b"").hexdigest()
    return rows.join(ends, ["key1", "key2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
