"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``tables_per_side`` short bundles of ``rows`` minhashes each are
computed per document; every pair of a bundle of the first and one of the second is a
table key, so ``tables_per_side ** 2`` tables cost only ``2 * tables_per_side * rows``
minhashes.  Their numbers follow from the least similarity asked for: documents that are
just so similar miss each other in all tables with a probability of at most ``MISS``, one
in 6,667, and closer ones more rarely.  At 0.85 that takes 10 bundles a side (one in
6,832 is missed), at 0.80 14 (one in 11,511).

1. One pass makes each document's set of 5-word shingles, its digest and its bundles.
2. Documents of equal sets fall into one class, the smallest doc_id stands for it.
3. Bundles that no other document has are left out, which for most documents are all;
   the others become table keys.  Members of a table bucket are tied to the bucket's
   smallest document: no pairs.  Components of these ties are the candidate groups.
4. The full sets of a candidate group meet in one task, which links them exactly.  It
   sweeps from one document over those not reached yet, the most central first, so a
   group of near copies costs about one sweep.  A group of more than ``GROUP_SHINGLES``
   is cut into blocks and every pair of blocks is a task: no link is lost.
5. A group's smallest linked document names it; what the tasks of a cut group found
   is joined as components of a graph once more.

Cases: a document without words has an empty set and no link; with fewer than five
words the whole sequence is one shingle; A-Z are lower-cased only.  A null doc_id takes
no part (component null, kept).  Rows that repeat a doc_id are one node: their texts
count as reachable from each other.  An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinora.llm import common
from kinora.llm.components import connected_components
from kinora.session import materialize

#: Text that is hashed at once; its words' arrays take some tens of bytes a letter.
RUN_BYTES = 1 << 18
#: Shingles that one task links at once (8 bytes each, several copies in memory).
GROUP_SHINGLES = 2_000_000
#: Table keys that one task makes and counts, and the most tasks.
TASK_KEYS, MOST_TASKS = 1 << 20, 100_000
#: Probability that two documents of the least similarity asked for meet in no table.
MISS = 1.5e-4
#: Bundles a side beyond which shorter bundles are taken, and the fewest.
MOST_TABLES, FEWEST_TABLES = 16, 10


def banding(least: int) -> tuple[int, int]:
    """(bundles a side, minhashes a bundle) for a similarity in hundredths: a pair misses
    with 1 - (1 - (1 - s ** rows) ** tables) ** 2, less than twice the inner power."""
    if not 0 < least <= 100:
        raise ValueError(f"no similarity in hundredths: {least}")
    for rows in (3, 2, 1):
        apart = 1 - (least / 100) ** rows
        tables = math.ceil(math.log(MISS / 2) / math.log(apart)) if apart else 1
        if tables <= MOST_TABLES:
            break
    return max(tables, FEWEST_TABLES), rows


def _functions(n: int) -> np.ndarray:
    """Odd multipliers of the n minhash functions, from fixed seeds."""
    return common.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(common.MULT)) | np.uint64(1)


def signatures(docs: DataFrame, tables_per_side: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit digest (h1, h2) and two arrays of bundles."""
    odd = _functions(2 * tables_per_side * rows)

    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, data, offsets in common.each_run(batches, most=RUN_BYTES):
            sets = list(common.shingle_sets(data, offsets))
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            bundles = np.zeros((len(sets), 2 * tables_per_side), np.uint64)
            if len(full):
                every = np.concatenate([sets[i] for i in full])
                starts = np.cumsum(sizes[full]) - sizes[full]
                for t, m in enumerate(odd):
                    low = common.mix(np.minimum.reduceat(every * m, starts))
                    bundles[full, t // rows] = common.mix(bundles[full, t // rows] * np.uint64(common.MULT) + low)
            digest = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) for s in sets])
            lists = [pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * tables_per_side,
                                              pa.array(np.ascontiguousarray(side).reshape(-1).view(np.int64)))
                     for side in (bundles[:, :tables_per_side], bundles[:, tables_per_side:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a).cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(digest[:, 0]), pa.array(digest[:, 1]), *lists], ["doc_id", "n_shingles", "h1", "h2", "a", "b"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, a array<long>, b array<long>")


def _shared(classes: DataFrame) -> DataFrame:
    """(rep, a, b): each class with those of its bundles, as (place, bundle), that another
    document has too, if there are such on both sides.  A table key that documents share
    takes a shared bundle of either side, so the others need not become keys."""
    sides = classes.where("doc_id = rep and n_shingles > 0").select(
        "rep", "h1", F.size("a").alias("first"), F.posexplode(F.concat("a", "b")).alias("i", "x"))
    several = sides.groupBy("i", "x").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("i", "x")
    side = lambda own, place: F.collect_set(F.when(own, F.struct(place.alias("i"), "x")))
    at, first = F.col("i"), F.col("first")
    # By the digest too: a doc_id may come with several texts.
    return (sides.join(several, ["i", "x"]).groupBy("rep", "h1").agg(side(at < first, at).alias("a"), side(at >= first, at - first).alias("b"))
            .where((F.size("a") > 0) & (F.size("b") > 0)).select("rep", "a", "b"))


def _ties(classes: DataFrame) -> DataFrame:
    """(a, b): each member of a table bucket with the bucket's smallest document.  The
    shared bundles are dealt before they become keys, so that a task counts ``TASK_KEYS``
    however few files they are in."""
    shared = materialize(_shared(classes), "shared")
    number = shared.agg(F.sum(F.size("a") * F.size("b"))).first()[0] or 0
    tasks = min(MOST_TASKS, max(1, -(-number // TASK_KEYS)))
    keys = (shared.repartition(tasks, "rep").select("rep", F.explode("a").alias("x"), "b").select("rep", "x", F.explode("b").alias("y"))
            .select("rep", F.xxhash64("x.i", "y.i", "x.x", "y.x").alias("key")))
    buckets = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").drop("last")
    return keys.join(buckets, "key").where("rep > hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()


def _sets(docs: DataFrame) -> DataFrame:
    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, data, offsets in common.each_run(batches, most=RUN_BYTES):
            sets = [s.tobytes() for s in common.shingle_sets(data, offsets)]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("grp"), part.column("blocks"), pa.array(sets, pa.binary())],
                                             ["doc_id", "grp", "blocks", "shingles"])
    return docs.select("doc_id", "grp", "blocks", "text").mapInArrow(run, "doc_id long, grp long, blocks int, shingles binary")


def linked(sets: list[np.ndarray], least: int) -> list[tuple[int, int]]:
    """A spanning forest of the links with 100 * intersection >= least * union: every
    component of the exact link graph is connected by the pairs returned."""
    sizes = np.array([len(s) for s in sets])
    words, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    common_words = np.bincount(tokens, minlength=len(words))
    central = np.argsort(-np.add.reduceat(common_words[tokens], starts) / sizes, kind="stable")
    mark = np.zeros(len(words), bool)
    reached = np.zeros(len(sets), bool)
    rest, rest_tokens, rest_starts = np.arange(len(sets)), tokens, starts
    out: list[tuple[int, int]] = []
    for first in central:
        if reached[first]:
            continue
        reached[first] = True
        queue = [int(first)]
        while queue:
            at = queue.pop()
            if reached[rest].sum() * 4 > len(rest):  # leave out what has been reached
                rest = rest[~reached[rest]]
                if not len(rest):
                    return out
                rest_tokens = np.concatenate([tokens[starts[i]:starts[i] + sizes[i]] for i in rest])
                rest_starts = np.cumsum(sizes[rest]) - sizes[rest]
            own = tokens[starts[at]:starts[at] + sizes[at]]
            mark[own] = True
            shared = np.add.reduceat(mark[rest_tokens], rest_starts, dtype=np.int64)
            mark[own] = False
            new = rest[(100 * shared >= least * (sizes[at] + sizes[rest] - shared)) & ~reached[rest]]
            reached[new] = True
            out += [(at, int(i)) for i in new]
            queue += new.tolist()
    return out


def _rooted(ids: list[int], pairs: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest id reachable from each id that has links or repeats."""
    parent = {i: i for i in ids}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i
    for x, y in pairs:
        low, high = sorted((root(ids[x]), root(ids[y])))
        parent[high] = low
    return {i: root(i) for i in parent}


def _links(sets: DataFrame, least: int) -> DataFrame:
    """(a, b): every document that has an exact link within its (group, block pair), and
    the smallest it reaches there; rows are streamed in sorted order."""
    @common.released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, own = None, [], []

        def flush():
            found = [(x, y) for x, y in _rooted(ids, linked(own, least)).items() if x != y] if len(own) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c) for c in ("grp", "i", "j", "doc_id", "shingles")]
            for grp, i, j, doc_id, shingles in zip(*(c.to_pylist() for c in columns[:4]), columns[4], strict=True):
                if (grp, i, j) != key:
                    yield from flush()
                    key, ids, own = (grp, i, j), [], []
                ids.append(doc_id)
                own.append(np.frombuffer(shingles.as_buffer(), np.uint64).copy())
        yield from flush()

    # A whole group is the one pair (0, 0); a row of a cut group goes to each pair with its block.
    mine = F.pmod(F.xxhash64("doc_id", "shingles"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j")))
    dealt = sets.select("doc_id", "grp", "shingles", F.explode(pairs).alias("p")).select("doc_id", "grp", "p.i", "p.j", "shingles")
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "grp", "i", "j").sortWithinPartitions("grp", "i", "j").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, least: int = 85, tables_per_side: int | None = None, rows: int | None = None,
                    group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; ``least`` is the similarity in hundredths.
    Bundles and minhashes are those of ``banding`` unless both are given."""
    common.small_batches(docs.sparkSession)
    if tables_per_side is None or rows is None:
        tables_per_side, rows = banding(least)
    sig = materialize(signatures(docs, tables_per_side, rows), "signatures")
    reps = sig.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    classes = materialize(sig.join(reps, ["h1", "h2"], "left").withColumn(
        "rep", F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id"))).select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"), "h1", "h2",
        F.when(F.col("doc_id") == F.col("rep"), F.col("a")).alias("a"), F.when(F.col("doc_id") == F.col("rep"), F.col("b")).alias("b")), "classes")
    groups = connected_components(_ties(classes))
    own = classes.where("doc_id = rep").groupBy(F.col("rep").alias("node")).agg(F.sum("n_shingles").alias("n"))
    members = groups.join(own, "node")
    weight = members.groupBy("component").agg(F.ceil(F.sum("n") / group_shingles * 2).cast("int").alias("blocks"))
    blocks = F.when(F.col("blocks") > 2, F.col("blocks")).otherwise(1)
    members = materialize(members.join(weight, "component").select(
        F.col("node").alias("doc_id"), F.col("component").alias("grp"), blocks.alias("blocks")), "members")
    sets = _sets(docs.select("doc_id", "text").join(members, "doc_id"))
    links = _links(sets.where(F.length("shingles") > 0), least).select(F.col("a").alias("node"), F.col("b").alias("component"))
    if not members.where("blocks > 1").isEmpty():  # what the tasks of a cut group found meets here
        links = connected_components(links.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return classes.select("doc_id", "n_shingles", "rep").join(links, classes.rep == links.node, "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "rep")).alias("kept"))
