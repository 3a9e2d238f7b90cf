"""Exact top-K cosine neighbours without a dense N x N matrix and without
emitting all pairs of a shared term.

Plan
----
1. ``doc_vectors`` is the term index: TF-IDF vectors as a stored table, over numbers of
   the terms that at least two documents share (a term of one document
   moves no score, only its norm).  A vector's entries stand rarest first, with the norm
   of its rare part (terms of at most ``RARE`` documents) and of the rest.
2. ``rare_first`` (once there are more blocks than neighbours wanted): documents meet
   others on rare terms only, at most ``RARE`` a term, so this join grows with the vectors
   and not with their square.  The sum over rare terms is a lower bound of a score and
   the K-th one a document's bound; without a shared rare term no score exceeds the norm
   of the rest (Cauchy-Schwarz).  Where the bound is above that norm the document is
   settled: its neighbours are among its partners, of which only those whose upper bound
   reaches the K-th lower one are scored in full.  Documents whose rare terms reach too few
   others for that are not joined at all.
3. ``topk_neighbours`` scores the other documents by blocks, or all of them once for both
   sides when fewer than half are settled: each pair of blocks is one task.  Blocks are
   held by term (``Postings``).  Terms shared by many documents of both blocks go through
   one dense matrix product, those of some documents are added term by term, the sparse
   tail is accumulated with ``bincount``: a term present in a third of all documents costs
   the same as any other dense column.  Of more than ``COPIES`` blocks no copies are dealt:
   blocks are stored packed, and each pair of partitions of these is a task that reads both.
4. Each task emits only its local top-K per source (ranked by the score quantised to
   1e-9, then neighbour id).  Because local and global orders are the same total order,
   the global top-K is the top-K of the union: a row_number per source over at most
   K * B candidates.

Self pairs and non-positive scores are dropped; the stored score is the quantised score
rounded half-even to 4 decimals.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinora.operators import term_blocks
from kinora.operators.tfidf import weighed_blocks
from kinora.session import default_parallelism, materialize

# FIXED VALUES: ranking quantum and output rounding.
SCORE_QUANTUM = 1e9      # scores are ranked on rint(score * 1e9)
OUTPUT_DECIMALS = 4      # stored similarity has 4 decimals

MAX_BLOCK = 2048         # documents per block (bounds the score block: 2048^2 doubles)
# Upper estimate of (term, weight) entries per block (2/3 entry per character of
# text; prose has about a third of that).  A group holds two blocks: ~2-3M
# string objects plus weights in practice (~250 MB in the worker) and one dense
# 2048 x 2048 score block (32 MB).
MAX_BLOCK_ENTRIES = 4_000_000
MIN_BLOCK = 128
PAIR_CHUNK = 8_000_000   # sparse-tail pairs expanded at once inside a group
DENSE = 256.0            # a pair in the sparse tail costs about this many dense products
OUTER = 512              # from so many pairs on a term of the sparse tail is added on its own
RARE = 8                 # a rare term has this many documents at most
TOPK_ROWS = 256          # source rows ranked at once inside a group
# Lower and upper bounds are compared with this margin over the ranking quantum.
MARGIN = 4e-9
COPIES = 8               # vectors are copied to the block pairs up to this many times, else read by each
PACKED_ENTRIES = 1_000_000  # entries of a block that is packed into one row
HELD_BLOCKS = 32         # packed blocks of a partition at most, some 10 MB each

CANDIDATE_SCHEMA = T.StructType([
    T.StructField("src", T.LongType()),
    T.StructField("dst", T.LongType()),
    T.StructField("q", T.LongType()),
])


def doc_vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                ngram_max: int = 2) -> DataFrame:
    """The term index: (doc_id, terms array<bigint> rarest first, weights array<double>
    of the L2-normalised vector, w: those before the norm, norm, n_rare, rare and rest: the norms of the first ``n_rare``
    entries and of the others, reach), a stored table.

    ``reach`` is the sum of squares of the rare entries, each counted once for every other
    document that has its term.  Documents are counted in blocks (``tfidf``), and numbers of
    terms are stored, so a recomputed task can not renumber them.  Stored weights are those
    before the norm: few are distinct."""
    schema = T.StructType.fromDDL("terms array<bigint>, w array<double>, norm double, n_rare int, rare double, rest double, reach double")
    stored = materialize(weighed_blocks(docs, lambda parts: term_blocks.vectors(parts, ngram_max, RARE), schema, id_col, text_col,
                                        ngram_max, numbered=True), "vectors")
    return _weighted(stored)


def _weighted(stored: DataFrame) -> DataFrame:
    return stored.withColumn("weights", F.transform("w", lambda x: x / F.col("norm")))


def choose_blocks(n_docs: int, parallelism: int, n_chars: int = 0) -> int:
    """Number of hash blocks.  ``n_chars`` (total text length) bounds the
    number of vector entries: a token takes >= 3 characters with its
    separator, and uni- plus bigrams give at most two entries per token."""
    by_size = max(math.ceil(n_docs / MAX_BLOCK), math.ceil((2 * n_chars / 3) / MAX_BLOCK_ENTRIES))
    # fewest blocks whose B(B+1)/2 block pairs still give every core a group:
    # more blocks only add replication
    b = 1
    while b * (b + 1) // 2 < parallelism:
        b += 1
    by_tasks = min(b, math.ceil(n_docs / MIN_BLOCK))
    return max(1, by_size, by_tasks)


# -- in-group kernel ----------------------------------------------------------

def _flatten(side: pd.DataFrame):
    lens = side["terms"].map(len).to_numpy()
    rows = np.repeat(np.arange(len(side)), lens)
    if lens.sum() == 0:
        return rows, np.zeros(0, dtype=object), np.zeros(0, np.float64)
    terms = np.concatenate(side["terms"].to_numpy())
    weights = np.concatenate(side["weights"].to_numpy()).astype(np.float64)
    return rows, terms, weights


class Postings(NamedTuple):
    """A block by term: the distinct terms in order, and of each its documents and weights."""
    n: int
    terms: np.ndarray
    sizes: np.ndarray
    rows: np.ndarray
    weights: np.ndarray

    def entries(self, which: np.ndarray) -> np.ndarray:
        """Places of the entries of some terms, term by term."""
        f = self.sizes[which]
        return np.repeat((np.cumsum(self.sizes) - self.sizes)[which] - (np.cumsum(f) - f), f) + np.arange(f.sum())


def postings(side: pd.DataFrame) -> Postings:
    rows, terms, weights = _flatten(side)
    order = np.argsort(terms, kind="stable")
    rows, terms, weights = rows[order], terms[order], weights[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(1, terms.size), bool), terms[1:] != terms[:-1]]))
    return Postings(len(side), terms[at], np.diff(at, append=terms.size), rows, weights)


def score_block(left: pd.DataFrame, right: pd.DataFrame | None) -> np.ndarray:
    """Exact cosine block S[i, j] = sum_t wL[i, t] * wR[j, t]."""
    own = postings(left)
    return score_postings(own, own if right is None else postings(right))


def score_postings(left: Postings, right: Postings) -> np.ndarray:
    """Exact cosine block of two blocks by term."""
    n_l, n_r = left.n, right.n
    scores = np.zeros((n_l, n_r), dtype=np.float64)
    if not (left.terms.size and right.terms.size):
        return scores
    place = np.minimum(np.searchsorted(right.terms, left.terms), right.terms.size - 1)
    li = np.flatnonzero(right.terms[place] == left.terms)
    ri = place[li]
    n_pairs = left.sizes[li].astype(np.int64) * right.sizes[ri]
    # A term is cheaper as a dense column once its pair count is a visible
    # fraction of the block (BLAS vs. per-pair numpy work).
    heavy = n_pairs * DENSE > float(n_l) * n_r
    if heavy.any():
        h = int(heavy.sum())
        sides = []
        for p, which in ((left, li[heavy]), (right, ri[heavy])):
            e, dense = p.entries(which), np.zeros((p.n, h))
            dense[p.rows[e], np.repeat(np.arange(h), p.sizes[which])] = p.weights[e]
            sides.append(dense)
        scores += sides[0] @ sides[1].T
    flat, base = scores.reshape(-1), left.rows.astype(np.int64) * n_r
    own = ~heavy & (n_pairs >= OUTER)
    l_end, r_end = np.cumsum(left.sizes), np.cumsum(right.sizes)
    for i, j in zip(li[own].tolist(), ri[own].tolist()):
        a, b = slice(l_end[i] - left.sizes[i], l_end[i]), slice(r_end[j] - right.sizes[j], r_end[j])
        at = np.add.outer(base[a], right.rows[b]).reshape(-1)  # a pair once
        flat[at] += np.multiply.outer(left.weights[a], right.weights[b]).reshape(-1)
    light = ~heavy & ~own
    li, ri = li[light], ri[light]
    e, fanout = left.entries(li), np.repeat(right.sizes[ri], left.sizes[li]).astype(np.int64)
    starts = np.repeat((r_end - right.sizes)[ri], left.sizes[li])
    begin, cum = 0, np.concatenate([[0], np.cumsum(fanout)])
    while begin < e.size:
        end = max(begin + 1, int(np.searchsorted(cum, cum[begin] + PAIR_CHUNK, side="right")) - 1)
        f = fanout[begin:end]
        ridx = np.repeat(starts[begin:end] - (cum[begin:end] - cum[begin]), f) + np.arange(cum[end] - cum[begin])
        flat += np.bincount(np.repeat(base[e[begin:end]], f) + right.rows[ridx],
                            weights=np.repeat(left.weights[e[begin:end]], f) * right.weights[ridx], minlength=n_l * n_r)
        begin = end
    return scores


def _row_topk(scores: np.ndarray, src_ids: np.ndarray, dst_ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k best positive scores of each row, never of a document with itself."""
    n_src, n_dst = scores.shape
    out = {"src": [np.zeros(0, np.int64)], "dst": [np.zeros(0, np.int64)], "q": [np.zeros(0, np.int64)]}
    order = np.argsort(dst_ids, kind="stable")
    wide = n_dst // (8 * k)  # columns in a group
    for at in range(0, n_src if n_dst else 0, TOPK_ROWS):
        part, ids = np.array(scores[at:at + TOPK_ROWS]), src_ids[at:at + TOPK_ROWS]
        place = np.minimum(np.searchsorted(dst_ids, ids, sorter=order), n_dst - 1)
        own = np.flatnonzero(dst_ids[order[place]] == ids)
        part[own, order[place[own]]] = 0.0
        keep = part > 0.0
        if wide > 1:
            # the k-th of the best of groups of columns is not above the k-th best of all
            groups = n_dst // wide
            best = part[:, :groups * wide].reshape(len(ids), wide, groups).max(axis=1)
            least = np.partition(best, groups - k, axis=1)[:, groups - k]
            keep &= part >= (least - 2.0 / SCORE_QUANTUM)[:, None]
        rows, cols = np.divmod(np.flatnonzero(keep), n_dst)
        q, dst = np.rint(part[rows, cols] * SCORE_QUANTUM).astype(np.int64), dst_ids[cols]
        ranked = np.lexsort((dst, -q, rows))
        begins = np.searchsorted(rows, np.arange(len(ids)))  # rows are ascending
        ranked = ranked[np.arange(len(rows)) - begins[rows] < k]
        for name, values in (("src", ids[rows[ranked]]), ("dst", dst[ranked]), ("q", q[ranked])):
            out[name].append(values)
    return pd.DataFrame({name: np.concatenate(values) for name, values in out.items()}).astype("int64")


def _block_pair_kernel(k: int, one_way: bool):
    """Local top-K of a block pair; ``one_way``: of the left side's documents only."""
    def kernel(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf["side"] == 0].reset_index(drop=True)
        right = pdf[pdf["side"] == 1].reset_index(drop=True)
        l_ids, r_ids = left["doc_id"].to_numpy(np.int64), right["doc_id"].to_numpy(np.int64)
        if left.empty or (right.empty and (one_way or key[0] != key[1])):  # a block without documents
            return pd.DataFrame({"src": [], "dst": [], "q": []}).astype("int64")
        if one_way:
            return _row_topk(score_block(left, right), l_ids, r_ids, k)
        if key[0] == key[1]:
            return _row_topk(score_block(left, None), l_ids, l_ids, k)
        s = score_block(left, right)
        return pd.concat([_row_topk(s, l_ids, r_ids, k), _row_topk(s.T, r_ids, l_ids, k)], ignore_index=True)
    return kernel


def block_candidates(vectors: DataFrame, k: int, n_blocks: int, sources: DataFrame | None = None,
                     source_blocks: int = 1) -> DataFrame:
    """(src, dst, q): local top-K of every block pair.  Without ``sources`` each unordered
    pair of blocks is scored once for both sides; with ``sources`` (vectors of some
    documents) each of their blocks meets every block of all documents."""
    def dealt(df: DataFrame, n: int) -> DataFrame:
        return df.select("doc_id", "terms", "weights", F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("b"))

    def side(df: DataFrame, own: str, other: str, low, high, number: int) -> DataFrame:
        return df.select(F.col("b").alias(own), F.explode(F.sequence(low, high)).alias(other), F.lit(number).alias("side"),
                         "doc_id", "terms", "weights")
    v = dealt(vectors, n_blocks)
    if sources is None:
        pairs = side(v, "pi", "pj", F.col("b"), F.lit(n_blocks - 1), 0).unionByName(
            side(v.where("b > 0"), "pj", "pi", F.lit(0), F.col("b") - 1, 1))
    else:
        pairs = side(dealt(sources, source_blocks), "pi", "pj", F.lit(0), F.lit(n_blocks - 1), 0).unionByName(
            side(v, "pj", "pi", F.lit(0), F.lit(source_blocks - 1), 1))
    return pairs.groupBy("pi", "pj").applyInPandas(_block_pair_kernel(k, sources is not None), CANDIDATE_SCHEMA)


PACKED_SCHEMA = "ids binary, norms binary, terms binary, sizes binary, rows binary, w binary, n_terms int, n_entries int"


def _pack(batches):
    """Blocks of whole rows, each packed into one row, by term."""
    held, entries = [], 0

    def packed():
        pdf = pd.concat(held, ignore_index=True).sort_values("doc_id", ignore_index=True)
        p = postings(pdf.rename(columns={"w": "weights"}))
        columns = {"ids": pdf["doc_id"].to_numpy(np.int64), "norms": pdf["norm"].to_numpy(np.float64), "terms": np.diff(p.terms, prepend=0),
                   "sizes": p.sizes.astype(np.uint16), "rows": p.rows.astype(np.uint16), "w": p.weights}
        return pd.DataFrame({c: [v.tobytes() if c in ("ids", "norms") else pa.compress(v.tobytes(), "zstd", asbytes=True)] for c, v in columns.items()}
                            | {"n_terms": len(p.terms), "n_entries": len(p.rows)})
    for batch in batches:
        for at in range(0, len(batch), MIN_BLOCK):
            held.append(batch.iloc[at:at + MIN_BLOCK])
            entries += int(held[-1]["terms"].map(len).sum())
            if entries >= PACKED_ENTRIES or sum(map(len, held)) >= MAX_BLOCK:
                yield packed()
                held, entries = [], 0
    if held:
        yield packed()
    held = []
    term_blocks.release()


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of each src."""
    src, dst, q = (found[c].to_numpy() for c in ("src", "dst", "q"))
    order = np.lexsort((dst, -q, src))
    src = src[order]
    begins = np.flatnonzero(np.concatenate([np.ones(min(1, src.size), bool), src[1:] != src[:-1]]))
    place = np.arange(src.size) - np.repeat(begins, np.diff(begins, append=src.size))
    return found.iloc[order[place < k]]


def _unpack(row, side: str) -> tuple[np.ndarray, Postings]:
    """(ids, their postings); weights are those that ``doc_vectors`` gives."""
    def column(name: str, kind, n: int) -> np.ndarray:
        return np.frombuffer(pa.decompress(row[f"{name}_{side}"], n * np.dtype(kind).itemsize, "zstd"), kind)
    n_terms, n = row[f"n_terms_{side}"], row[f"n_entries_{side}"]
    ids, norms = np.frombuffer(row[f"ids_{side}"], np.int64), np.frombuffer(row[f"norms_{side}"])
    rows = column("rows", np.uint16, n).astype(np.int64)
    return ids, Postings(len(ids), np.cumsum(column("terms", np.int64, n_terms)), column("sizes", np.uint16, n_terms).astype(np.int64),
                         rows, column("w", np.float64, n) / norms[rows])


def crossed_candidates(vectors: DataFrame, k: int, sources: DataFrame | None = None) -> DataFrame:
    """What ``block_candidates`` gives, without copies of the vectors: they are stored once
    more, packed into blocks, and each pair of partitions of these is a task that reads both
    and gives the best of all its blocks."""
    # Each partition of either side sends k candidates a document: a few tasks a core, but
    # partitions that a task can hold.
    most = math.ceil(math.sqrt(6 * default_parallelism(vectors.sparkSession)))

    def packed(df: DataFrame) -> DataFrame:
        blocks = materialize(df.select("doc_id", "terms", "w", "norm").mapInPandas(_pack, PACKED_SCHEMA), "blocks")
        return blocks.repartition(max(most, math.ceil(blocks.count() / HELD_BLOCKS)))

    def side(blocks: DataFrame, name: str) -> DataFrame:
        return blocks.select(*(F.col(c).alias(f"{c}_{name}") for c in blocks.columns), F.substring("ids", 1, 8).alias(f"first_{name}"))
    one_way, right = sources is not None, packed(vectors)
    pairs = side(packed(sources) if one_way else right, "l").hint("shuffle_replicate_nl").crossJoin(side(right, "r"))
    if not one_way:  # a block's first id is its own
        pairs = pairs.where(F.col("first_l") <= F.col("first_r"))
    pairs = pairs.drop("first_l", "first_r")

    def run(batches):
        best, held = {}, None

        def add(block: bytes, found: pd.DataFrame) -> None:
            best[block] = _best(pd.concat([best[block], found]), k) if block in best else found
        for batch in batches:
            for _, row in batch.iterrows():
                if held != row["ids_l"]:
                    held, (l_ids, left) = row["ids_l"], _unpack(row, "l")
                same = not one_way and row["ids_r"] == held
                r_ids, other = (l_ids, left) if same else _unpack(row, "r")
                scores = score_postings(left, other)
                add(held, _row_topk(scores, l_ids, r_ids, k))
                if not (one_way or same):
                    add(row["ids_r"], _row_topk(scores.T, r_ids, l_ids, k))
        yield from best.values()
        term_blocks.release()
    return pairs.mapInPandas(run, CANDIDATE_SCHEMA)


def _dots(batches):
    """(src, dst, q) of rows that hold both vectors."""
    for pdf in batches:
        q = []
        for ta, wa, tb, wb in zip(pdf["ta"], pdf["wa"], pdf["tb"], pdf["wb"]):
            _, i, j = np.intersect1d(ta, tb, assume_unique=True, return_indices=True)
            q.append(np.rint(float(np.dot(np.asarray(wa)[i], np.asarray(wb)[j])) * SCORE_QUANTUM))
        yield pd.DataFrame({"src": pdf["src"], "dst": pdf["dst"], "q": np.array(q, np.float64).astype(np.int64)})


def rare_first(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(settled documents: doc_id; (src, dst, q) that hold their top-K)."""
    postings = vectors.where("n_rare > 0").select(
        "doc_id", "rare", "rest", "reach", F.explode(F.arrays_zip(F.slice("terms", 1, F.col("n_rare")).alias("term"),
                                                         F.slice("weights", 1, F.col("n_rare")).alias("w"))).alias("e"))
    postings = postings.select("doc_id", "rare", "rest", "reach", F.col("e.term").alias("term"), F.col("e.w").alias("w"))
    # A lower bound with a partner never exceeds the norm of the rare part, nor of those
    # entries of it that the partner has too: k partners whose bound is above the rest need
    # k times its square within reach.  Others can not be settled.
    a = postings.where((F.col("rare") > F.col("rest")) & (F.col("reach") + MARGIN >= k * F.col("rest") * F.col("rest"))).select(F.col("doc_id").alias("src"), F.col("rest").alias("rest_a"), "term", F.col("w").alias("wa"))
    b = postings.select(F.col("doc_id").alias("dst"), F.col("rest").alias("rest_b"), "term", F.col("w").alias("wb"))
    pairs = materialize(a.join(b, "term").where("src <> dst").groupBy("src", "dst").agg(
        F.sum(F.col("wa") * F.col("wb")).alias("low"), F.first("rest_a").alias("rest_a"), F.first("rest_b").alias("rest_b")), "rare-pairs")
    kth = pairs.withColumn("r", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("low")))).where(F.col("r") == k)
    bounds = materialize(kth.where(F.col("low") > F.col("rest_a") + MARGIN).select("src", F.col("low").alias("bound")), "settled")
    open_ = pairs.join(bounds, "src").where(F.col("low") + F.col("rest_a") * F.col("rest_b") + MARGIN >= F.col("bound")).select("src", "dst")
    def named(own: str, terms: str, weights: str) -> DataFrame:
        return vectors.select(F.col("doc_id").alias(own), F.col("terms").alias(terms), F.col("weights").alias(weights))
    scored = open_.join(named("src", "ta", "wa"), "src").join(named("dst", "tb", "wb"), "dst").mapInPandas(_dots, CANDIDATE_SCHEMA)
    return bounds.select(F.col("src").alias("doc_id")), scored.where("q > 0")


def topk_neighbours(spark: SparkSession, vectors: DataFrame, k: int, n_blocks: int, settle: bool = False) -> DataFrame:
    """(src, dst, rank, q, score) top-K cosine neighbours per document.

    ``settle`` takes the documents that ``rare_first`` settles out of the block product;
    it needs the columns of ``doc_vectors``."""
    if settle:
        settled, cands = rare_first(vectors, k)
        n_all = vectors.count()
        n_open = n_all - settled.count()
        if 2 * n_open > n_all:  # each pair once for both sides costs less
            settle = False
        elif n_open:
            left = _weighted(materialize(vectors.drop("weights").join(settled, "doc_id", "left_anti"), "open-vectors"))
            blocks = max(1, math.ceil(n_blocks * n_open / n_all))
            cands = cands.unionByName(crossed_candidates(vectors, k, left) if n_blocks > COPIES else block_candidates(vectors, k, n_blocks, left, blocks))
    if not settle:
        cands = crossed_candidates(vectors, k) if n_blocks > COPIES else block_candidates(vectors, k, n_blocks)
    w = Window.partitionBy("src").orderBy(F.col("q").desc(), F.col("dst").asc())
    ranked = cands.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
    scale = SCORE_QUANTUM / 10 ** OUTPUT_DECIMALS
    return ranked.select(
        "src", "dst", "rank", "q",
        (F.rint(F.col("q") / F.lit(scale)) / F.lit(float(10 ** OUTPUT_DECIMALS))).alias("score"))


def content_neighbours(spark: SparkSession, items: DataFrame, k: int, id_col: str = "movie_id",
                       text_col: str = "feature_text", n_blocks: int | None = None, settle: bool | None = None) -> DataFrame:
    """Serving-table form: movie_id, recommended_movie_id, rank, similarity_score.

    Settling a document moves about k vectors to it, the block product n_blocks copies of
    its own: unless ``settle`` says so, the cheaper one is taken.  Results are the same."""
    if n_blocks is None:
        # one pass over the (cheap) input decides the block layout
        stats = items.agg(F.count(F.lit(1)).alias("n"),
                          F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("c")).first()
        n_blocks = choose_blocks(int(stats["n"]), default_parallelism(spark), int(stats["c"]))
    vec = doc_vectors(items, id_col, text_col)
    nn = topk_neighbours(spark, vec, k, n_blocks, n_blocks > k if settle is None else settle)
    return nn.select(F.col("src").alias(id_col), F.col("dst").alias(f"recommended_{id_col}"),
                     "rank", F.col("score").alias("similarity_score"))
