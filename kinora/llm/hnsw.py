"""Nearest neighbours by inner product with one small-world graph per shard.

Distinct usable vectors are parted by norm, a factor of four a class, and each class is
dealt to shards by a hash, so the vectors of a shard are of comparable length.  A shard's
task builds a hierarchical navigable small-world graph and keeps it as flat neighbour
arrays (one int32 matrix per level).  Vectors in the graph are scaled by the power of two
above their class and queries to unit length, which changes no order; inner product
becomes a distance by one more coordinate, ``sqrt(1 - |x|**2)``, which is 0 for a query.
So neither a few very long vectors nor the scale of all cost the graph its digits.  The
queries are searched in every shard, each shard's best are scored exactly, in double
precision on the original vectors, and a query's best of all shards are merged.

Equal vectors share one graph node with their ``k + 1`` smallest ids, all that a search
for k can return, so a very common vector neither fills a graph nor a result.

The shard count follows the rows (``shard_rows``), the session's parallelism and the
classes (at most 1,100 of double precision); recall does not fall as shards are added,
since every shard is searched.

Cases: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components take no part, as queries or candidates; a null vec_id takes none;
rows that repeat an id with one vector count once; fewer candidates than k give shorter
lists; scores are sums in double precision, which any float column fits (components of
double columns beyond about 1e150 would overflow them); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinora.llm import common
from kinora.session import materialize

#: Rows of queries that one task holds at a time.
QUERY_ROWS = 4096


class Graph:
    """A hierarchical graph over the rows of ``x`` under squared Euclidean distance."""

    def __init__(self, x: np.ndarray, links: int = 16, width: int = 80, seed: int = 7) -> None:
        self.x, self.links, self.width = x, links, width
        n = len(x)
        rng = np.random.default_rng(seed)
        self.level = np.minimum(rng.exponential(1 / np.log(links), n).astype(np.int64), 12)
        # Flat neighbour arrays per level, filled from the left, -1 beyond.
        self.near = [np.full((n if i == 0 else int((self.level >= i).sum()), 2 * links if i == 0 else links), -1, np.int32)
                     for i in range(int(self.level.max(initial=0)) + 1)]
        self.row = [np.cumsum(self.level >= i) - 1 for i in range(len(self.near))]  # of a node in its level's array
        self.half = (x * x).sum(1) / 2
        self.seen, self.mark = np.zeros(n, np.int64), 0
        order = np.argsort(-self.level, kind="stable")  # upper levels stand before the lower fill
        self.entry = int(order[0]) if n else -1
        for node in order[1:].tolist():
            self._insert(node)

    def _distance(self, q: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return self.half[nodes] - self.x[nodes] @ q

    def _greedy(self, q: np.ndarray, at: int, level: int) -> int:
        best = self.half[at] - self.x[at] @ q
        while True:
            near = self.near[level][self.row[level][at]]
            near = near[near >= 0]
            if not len(near):
                return at
            d = self._distance(q, near)
            i = int(d.argmin())
            if not d[i] < best:
                return at
            at, best = int(near[i]), d[i]

    def beam(self, q: np.ndarray, start: int, width: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes met by best-first search, nearest first."""
        self.mark += 1
        seen, mark, near, row = self.seen, self.mark, self.near[level], self.row[level]
        nodes = np.array([start])
        dist = self._distance(q, nodes)
        open_ = np.ones(1, bool)
        seen[start] = mark
        while open_.any():
            # A few nearest unexpanded nodes at once: fewer, larger steps.
            take = np.flatnonzero(open_)[:4]
            open_[take] = False
            new = np.unique(near[row[nodes[take]]])
            new = new[new >= 0]
            new = new[seen[new] != mark]
            if not len(new):
                continue
            seen[new] = mark
            d = self._distance(q, new)
            if len(nodes) >= width:
                keep = d < dist[-1]
                new, d = new[keep], d[keep]
                if not len(new):
                    continue
            nodes, dist, open_ = np.concatenate([nodes, new]), np.concatenate([dist, d]), np.concatenate([open_, np.ones(len(new), bool)])
            order = np.argsort(dist, kind="stable")[:width]
            nodes, dist, open_ = nodes[order], dist[order], open_[order]
        return nodes, dist

    def _diverse(self, nodes: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
        """Nearest first, leaving out a node that is nearer to one taken than to the centre;
        free places go to the nearest left out."""
        if len(nodes) <= most:
            return nodes
        x = self.x[nodes]
        between = self.half[nodes][:, None] + self.half[nodes][None, :] - x @ x.T
        taken: list[int] = []
        reach = np.full(len(nodes), np.inf)
        for i in range(len(nodes)):
            if reach[i] > dist[i]:
                taken.append(i)
                if len(taken) == most:
                    break
                reach = np.minimum(reach, between[i])
        if len(taken) < most:
            rest = np.setdiff1d(np.arange(len(nodes)), taken)[:most - len(taken)]
            taken += rest.tolist()
        return nodes[np.array(taken)]

    def _insert(self, node: int) -> None:
        q, level = self.x[node], int(self.level[node])
        at = self.entry
        for i in range(int(self.level[self.entry]), level, -1):
            at = self._greedy(q, at, i)
        for i in range(min(level, int(self.level[self.entry])), -1, -1):
            nodes, dist = self.beam(q, at, self.width, i)
            at = int(nodes[0])
            chosen = self._diverse(nodes, dist + self.half[node], self.links)
            near, row = self.near[i], self.row[i]
            near[row[node], :len(chosen)] = chosen
            most = near.shape[1]
            for other in chosen.tolist():
                line = near[row[other]]
                free = int((line >= 0).sum())
                if free < most:
                    line[free] = node
                else:
                    all_ = np.append(line, node).astype(np.int64)
                    d = self._distance(self.x[other], all_) + self.half[other]
                    order = np.argsort(d, kind="stable")
                    best = self._diverse(all_[order], d[order], most)
                    line[:] = -1
                    line[:len(best)] = best

    def search(self, q: np.ndarray, k: int, width: int) -> np.ndarray:
        at = self.entry
        for i in range(int(self.level[self.entry]), 0, -1):
            at = self._greedy(q, at, i)
        return self.beam(q, at, max(width, k))[0][:k]


def _usable(rows: DataFrame) -> DataFrame:
    v = F.col("v")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null").where(good)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (size.n if size else 0))


def _zero_is_one(v: Column) -> Column:
    """-0.0 and 0.0 are one value, so that equal vectors group together."""
    return F.transform(v, lambda x: x + F.lit(0.0))


def _exponent(v: Column) -> Column:
    """Half the binary logarithm of the norm, rounded down: no square over- or underflows."""
    top = F.array_max(F.transform(v, F.abs))
    rest = F.aggregate(F.transform(v, lambda x: x / top), F.lit(0.0), lambda a, x: a + x * x)
    return F.floor((F.log2(top) + F.log2(rest) / 2) / 2).cast("int")


def _scaled(x: np.ndarray, exponent: int) -> np.ndarray:
    """Rows of norm below 1 with the coordinate that makes them unit vectors."""
    x = np.ldexp(x, -2 * (exponent + 1))
    return np.column_stack([x, np.sqrt(np.maximum(1 - (x * x).sum(1), 0))]).astype(np.float32)


def _unit(q: np.ndarray) -> np.ndarray:
    q = q / np.abs(q).max()
    return np.append(q / np.sqrt((q * q).sum()), 0).astype(np.float32)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, shard_rows: int = 50_000, links: int = 16, width: int = 80,
            search_width: int = 120) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` candidates of largest inner
    product found, itself left out, ties to the smaller id.  ``is_query`` is a condition
    on vec_id."""
    spark = rows.sparkSession
    usable = materialize(_usable(rows).withColumn("v", _zero_is_one(F.col("v"))), "vectors")
    # At most one row per class of norms.
    classes = usable.groupBy(_exponent(F.col("v")).alias("e")).count().orderBy("e").collect()
    schema = "query_id long, vec_id long, score double"
    if not classes:
        return spark.createDataFrame([], schema).withColumn("rank", F.lit(1)).select("query_id", "rank", "vec_id", "score")
    n, wide = sum(c["count"] for c in classes), spark.sparkContext.defaultParallelism
    shares = [max(1, -(-c["count"] // shard_rows), round(wide * c["count"] / n)) for c in classes]
    shards = sum(shares)
    dealt = spark.createDataFrame([(c.e, s, sum(shares[:i])) for i, (c, s) in enumerate(zip(classes, shares, strict=True))], "e int, share int, before int")
    # A vector's k + 1 smallest ids; the rank limit is applied before the shuffle too.
    first = Window.partitionBy("v").orderBy("vec_id")
    nodes = (usable.distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
             .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    nodes = nodes.withColumn("e", _exponent(F.col("v"))).join(F.broadcast(dealt), "e").select(
        "v", "ids", "e", (F.col("before") + F.pmod(F.xxhash64("v"), F.col("share"))).cast("int").alias("shard"))
    asked = materialize(usable.where(is_query).distinct().select("vec_id", "v"), "queries")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard: vectors, ids and the graph's flat arrays, as one row."""
        parts: dict[int, list] = {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            for s in np.unique(shard).tolist():
                parts.setdefault(s, []).append(batch.filter(pa.array(shard == s)))
        for s, own in parts.items():
            t = pa.Table.from_batches(own).combine_chunks()
            n = t.num_rows
            x = t.column("v").combine_chunks().flatten().to_numpy().reshape(n, -1)
            order = np.lexsort(x.T)  # rows come in any order, the graph must not
            x, ids = np.ascontiguousarray(x[order]), t.column("ids").combine_chunks().take(pa.array(order))
            exponent = t.column("e")[0].as_py()
            graph = Graph(_scaled(x, exponent), links, width)
            sizes = np.array([len(i) for i in ids])
            blob = [x.tobytes(), ids.flatten().to_numpy().astype(np.int64).tobytes(), sizes.astype(np.int64).tobytes(),
                    graph.level.tobytes(), *(a.tobytes() for a in graph.near)]
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([n], pa.int64()), pa.array([exponent], pa.int32()),
                                              pa.array([graph.entry], pa.int64()), pa.array([blob], pa.list_(pa.binary()))],
                                             ["shard", "n", "e", "entry", "parts"])

    # A shard a task: none waits behind another one's graph.
    index = materialize(nodes.select("shard", "v", "ids", "e").repartitionById(shards, "shard")
                        .mapInArrow(build, "shard int, n long, e int, entry long, parts array<binary>"), "hnsw")
    # Queries in blocks of a bounded size, each against every shard: a stated query set.
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    pairs = (asked.groupBy(block.alias("block")).agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).join(index, "shard"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n, exponent, entry, parts = (batch.column(c)[i] for c in ("n", "e", "entry", "parts"))
                blob = [b.as_buffer() for b in parts]
                x = np.frombuffer(blob[0], np.float64).reshape(n.as_py(), -1)
                ids, sizes, level = (np.frombuffer(b, np.int64) for b in blob[1:4])
                starts = np.cumsum(sizes) - sizes
                graph = Graph(np.zeros((0, x.shape[1] + 1), np.float32), links, width)
                graph.x = _scaled(x, exponent.as_py())
                graph.half, graph.seen, graph.level, graph.entry = (graph.x ** 2).sum(1) / 2, np.zeros(len(x), np.int64), level, entry.as_py()
                graph.near = [np.frombuffer(b, np.int32).reshape(-1, 2 * links if j == 0 else links) for j, b in enumerate(blob[4:])]
                graph.row = [np.cumsum(level >= j) - 1 for j in range(len(graph.near))]
                out: list[tuple] = []
                for query in batch.column("queries")[i].values.to_pylist():
                    q = np.array(query["v"])
                    found = graph.search(_unit(q), k + 1, search_width)
                    score = np.repeat(np.array([np.dot(x[f], q) for f in found]), sizes[found])
                    own = np.concatenate([ids[starts[f]:starts[f] + sizes[f]] for f in found])
                    score, own = score[own != query["vec_id"]], own[own != query["vec_id"]]
                    best = np.lexsort((own, -score))[:k]
                    out.append((np.full(len(best), query["vec_id"]), own[best], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    common.small_batches(spark)
    found = pairs.select("n", "e", "entry", "parts", "queries").repartition(shards * blocks).mapInArrow(search, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
