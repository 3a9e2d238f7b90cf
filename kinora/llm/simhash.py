"""SimHash near-dedup by a binary trie joined with itself.

1. One pass makes each document's 64-bit fingerprint: A-Z lower-cased, runs of four
   words with repeats, XXH64 of each (seed 42), a bit is 1 if over half of them set it.
2. Documents of equal fingerprints fall into one class, the smallest doc_id stands for it.
3. A fingerprint is dealt ``errors + 1`` times, rotated so that each of as many blocks of
   its bits comes first.  Of two fingerprints that differ in at most ``errors`` bits, one
   rotation has at most ``j - 1`` differing bits in its first ``j`` blocks, for every j
   (blocks on a circle, started after the place where the running excess is largest).  So
   in that rotation the first blocks are equal, which deals both to one shard, and the
   trie join has the Hamming error budget ``j - 1`` up to the end of block j.
4. A shard's fingerprints form a path-compressed binary trie.  For every inner node its
   two subtries are traversed together: a pair of nodes whose prefixes differ in more bits
   than the budget at their common depth is pruned, a pair that cannot differ in more
   than ``errors`` bits anywhere below is linked as a whole, and so is dropped a pair that
   is linked already.  Nodes are taken from the leaves up and pairs depth first in
   chunks, so memory is bounded; a shard gives at most one link per fingerprint and round.
5. Links of all shards are joined as components.

A shard of more than ``SHARD`` fingerprints is cut into blocks by a hash, every pair of
blocks is a task.  The counts of shards that decide it are at most ``(errors + 1) *
2 ** 13`` rows, which are broadcast.

Cases: a null text, or one without words, has the fingerprint zero, which links like any
other; with fewer than four words the whole sequence is hashed.  A null doc_id takes no
part (component null).  Rows that repeat a doc_id are one node: their texts count as
reachable from each other.  An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.llm.components import connected_components
from kinora.session import materialize

SEED, WORDS, BITS = 42, 4, 64
#: Shingles hashed at once, which bounds a worker's arrays (64 bytes each).
AT_ONCE = 1 << 16
#: Fingerprints of a shard beyond which it is cut, and of shards joined as one trie.
SHARD = 1 << 18
#: Node pairs expanded at once.
PAIRS = 1 << 18


def shingle_hashes(text: bytes, n: int = WORDS) -> Iterator[int]:
    """XXH64 of each run of ``n`` words of a text, repeats included."""
    words = text.lower().split()  # bytes: only A-Z are lower-cased, only ASCII space parts
    if not words:
        return
    n = min(n, len(words))
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    del words
    digest = xxhash.xxh64_intdigest
    for a, b in zip(starts[:len(starts) - n + 1].tolist(), ends[n - 1:].tolist(), strict=True):
        yield digest(joined[a:b], SEED)


def fingerprint(text: bytes) -> int:
    """The 64-bit SimHash of one text, its hashes taken in bounded runs."""
    hashes, total, ones = shingle_hashes(text), 0, np.zeros(BITS, np.int64)
    while len(h := np.fromiter(itertools.islice(hashes, AT_ONCE), np.uint64)):
        total += len(h)
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(">u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim(None)
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            found = [fingerprint(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


# -- blocks and rotations ------------------------------------------------------
def block_widths(errors: int) -> list[int]:
    """Widths of the ``errors + 1`` blocks of a fingerprint."""
    if not 0 <= errors < BITS:
        raise ValueError(f"differing bits must be 0 to {BITS - 1}: {errors}")
    k = errors + 1
    return [BITS // k + (i < BITS % k) for i in range(k)]


def budgets(errors: int, rotation: int) -> np.ndarray:
    """Differing bits allowed in the first d bits of a rotation, for d = 0 to 64."""
    widths = block_widths(errors)
    widths = widths[rotation:] + widths[:rotation]
    return np.concatenate([[0], np.repeat(np.arange(errors + 1), widths)])


def _turned(fp: Column, by: int) -> Column:
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def rotations(classes: DataFrame, errors: int) -> DataFrame:
    """rotation, shard (the first block's value) and the rotated fingerprint of each class."""
    widths = block_widths(errors)
    turned = [F.struct(F.lit(i).alias("rotation"), F.shiftrightunsigned(_turned(F.col("fp"), sum(widths[:i])), BITS - w).alias("shard"),
                       _turned(F.col("fp"), sum(widths[:i])).alias("bits")) for i, w in enumerate(widths)]
    return classes.select("rep", F.explode(F.array(*turned)).alias("t")).select("t.*", "rep")


# -- the trie of one shard, joined with itself -----------------------------------
class Trie:
    """Path-compressed binary trie of sorted distinct 64-bit values.  Inner node i parts
    the values at i and i + 1 where it was made; leaves follow the n - 1 inner nodes."""

    def __init__(self, bits: np.ndarray) -> None:
        n = len(bits)
        self.bits, self.inner = bits, n - 1
        differ = bits[1:] ^ bits[:-1]
        depth = BITS - _length(differ)  # bits that neighbours share
        self.low, self.high = np.zeros(2 * n - 1, np.int64), np.zeros(2 * n - 1, np.int64)
        self.left, self.right = np.zeros(n - 1, np.int64), np.zeros(n - 1, np.int64)
        self.depth = np.concatenate([depth, np.full(n, BITS)]).astype(np.int64)
        self.vary = np.zeros(2 * n - 1, np.uint64)
        self.low[n - 1:] = self.high[n - 1:] = np.arange(n)
        self._grow(differ)

    def _grow(self, differ: np.ndarray) -> None:
        """Nodes from the deepest up: each joins the subtries left and right of its gap."""
        n, depth = len(self.bits), self.depth
        top = np.arange(n) + n - 1  # the node over each run of values, kept at its two ends
        self.order = np.argsort(-depth[:n - 1], kind="stable")
        at = 0
        # Gaps of one depth never share a subtrie, as two values part once at a depth.
        ordered = depth[self.order]
        while at < n - 1:
            end = int(np.searchsorted(-ordered, -ordered[at], "right"))
            gap = self.order[at:end]
            left, right = top[gap], top[gap + 1]
            self.left[gap], self.right[gap] = left, right
            self.low[gap], self.high[gap] = self.low[left], self.high[right]
            self.vary[gap] = (self.vary[left] | self.vary[right] | (self.bits[self.low[left]] ^ self.bits[self.low[right]]))
            top[self.low[gap]] = top[self.high[gap]] = gap
            at = end


def _length(x: np.ndarray) -> np.ndarray:
    """Number of bits up to the highest one that is set."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x | x >> np.uint64(shift)
    return np.bitwise_count(x).astype(np.int64)


class Linked:
    """Which leaves are linked, and a spanning forest of the links."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Links between leaves; those within one component are dropped."""
        while True:
            x, y = self.label[a], self.label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            open_ = low < high
            if not open_.any():
                return
            a, b, low, high = a[open_], b[open_], low[open_], high[open_]
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]  # one new parent a component
            self.edges.append((a[first], b[first]))
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.label = parent[self.label]

    def pure(self) -> np.ndarray:
        """Running count of places where neighbouring leaves are in different components."""
        return np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])


def trie_links(bits: np.ndarray, budget: np.ndarray, errors: int, pairs: int = PAIRS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between places of sorted distinct values that differ in at most ``errors``
    bits, and at no depth in more than ``budget``: enough to connect each component."""
    if len(bits) < 2:
        return []
    trie, linked = Trie(bits), Linked(len(bits))
    mask = np.array([((1 << d) - 1) << (BITS - d) for d in range(BITS + 1)], np.uint64)
    # Children of a node part at its own depth, so it must allow one differing bit there.
    nodes = trie.order[budget[np.minimum(trie.depth[trie.order] + 1, BITS)] > 0]
    for at in range(0, len(nodes), pairs):
        own = nodes[at:at + pairs]
        stack = [(trie.left[own], trie.right[own])]
        while stack:
            u, v = stack.pop()
            if len(u) > pairs:
                stack.append((u[pairs:], v[pairs:]))
                u, v = u[:pairs], v[:pairs]
            prefix = bits[trie.low[u]] ^ bits[trie.low[v]]
            common_depth = np.minimum(trie.depth[u], trie.depth[v])
            near = np.bitwise_count(prefix & mask[common_depth]) <= budget[common_depth]
            u, v, prefix = u[near], v[near], prefix[near]
            whole = np.bitwise_count(prefix | trie.vary[u] | trie.vary[v]) <= errors
            if whole.any():
                _link(trie, linked, u[whole], v[whole])
            u, v = u[~whole], v[~whole]
            same = linked.label[trie.low[u]] == linked.label[trie.low[v]]
            if same.any():  # both sides in one component: nothing to find below
                turns = linked.pure()
                one = same & (turns[trie.high[u]] == turns[trie.low[u]]) & (turns[trie.high[v]] == turns[trie.low[v]])
                u, v = u[~one], v[~one]
            if not len(u):
                continue
            deeper = trie.depth[u] > trie.depth[v]  # the node that parts first is replaced by its children
            u, v = np.where(deeper, v, u), np.where(deeper, u, v)
            stack.append((np.concatenate([trie.left[u], trie.right[u]]), np.concatenate([v, v])))
    return linked.edges


def _link(trie: Trie, linked: Linked, u: np.ndarray, v: np.ndarray) -> None:
    """Link all leaves below pairs of nodes: runs of neighbours, and the first of each."""
    runs = np.zeros(len(trie.bits) + 1, np.int64)
    for node in (u, v):
        np.add.at(runs, trie.low[node], 1)
        np.add.at(runs, trie.high[node], -1)
    at = np.flatnonzero(np.cumsum(runs)[:-1])
    linked.add(np.concatenate([trie.low[u], at]), np.concatenate([trie.low[v], at + 1]))


# -- all shards --------------------------------------------------------------------
def shard_links(rotated: DataFrame, errors: int, shard: int = SHARD) -> DataFrame:
    """(a, b): classes that a shard links; whole shards up to ``shard`` fingerprints are
    joined as one trie, in which those of different shards are pruned at the top."""
    limits = [budgets(errors, i) for i in range(errors + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim(None)
        key, held, n = None, [], 0

        def flush():
            if n > 1:
                bits, reps = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.argsort(bits)
                for a, b in trie_links(bits[order], limits[key[0]], errors):
                    yield pa.RecordBatch.from_arrays([pa.array(reps[order[a]]), pa.array(reps[order[b]])], ["a", "b"])

        for batch in batches:
            rotation, whole, i, j, value = (batch.column(c).to_numpy() for c in ("rotation", "cut", "i", "j", "shard"))
            bits, reps = batch.column("bits").to_numpy().view(np.uint64), batch.column("rep").to_numpy()
            parts = np.stack([rotation, np.where(whole == 1, -1, value), i, j])
            cuts = np.flatnonzero((parts[:, 1:] != parts[:, :-1]).any(axis=0) | (value[1:] != value[:-1])) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(bits)]):
                now = tuple(parts[:, a].tolist())
                # A new trie for another rotation or cut shard, and between whole shards once there is enough.
                if now != key or (n >= shard and last != value[a]):
                    yield from flush()
                    key, held, n = now, [], 0
                held.append((bits[a:b], reps[a:b]))
                n, last = n + b - a, value[a]
        yield from flush()

    sizes = rotated.groupBy("rotation", "shard").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per rotation and value of its first block.
    sized = rotated.join(F.broadcast(sizes), ["rotation", "shard"]).withColumn("cut", F.when(
        F.col("n") > shard, F.ceil(F.col("n") / shard * 2)).otherwise(1).cast("int"))
    mine = F.pmod(F.xxhash64("bits"), F.col("cut")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("cut") - 1), lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j")))
    dealt = sized.select("rotation", "shard", "cut", "bits", "rep", F.explode(pairs).alias("p")).select("rotation", "shard", "cut", "p.i", "p.j", "bits", "rep")
    n = int(rotated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "rotation", "shard", "i", "j").sortWithinPartitions("rotation", "cut", "shard", "i", "j")
            .mapInArrow(run, "a long, b long"))


def simhash_components(docs: DataFrame, errors: int = 4, shard: int = SHARD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    common.small_batches(docs.sparkSession)
    rows = materialize(fingerprints(docs), "simhash")
    classes = materialize(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    links = shard_links(rotations(classes, errors), errors, shard)
    repeated = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x < y").select("doc_id")
    texts = rows.join(repeated, "doc_id", "left_semi").join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    groups = connected_components(links.unionAll(texts))
    named = classes.join(groups, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
