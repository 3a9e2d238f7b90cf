import hashlib
import random

import numpy as np
import pytest

from kinora.llm import suffix_dedup as S

L = S.WINDOW


def plain(rows):
    least = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - L + 1):
            least[b[p:p + L]] = min(least.get(b[p:p + L], S.NOBODY), S.NOBODY if i is None else i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - L + 1):
            if least[b[p:p + L]] < (S.NOBODY if i is None else i):
                gone[p:p + L] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_bytes string")
    assert sorted(map(tuple, S.digest(S.remove_repeats(docs)).collect()), key=str) == plain(rows)


def corpus(seed):
    """Random texts that share passages of about the window's length, with edges that differ."""
    rng = random.Random(seed)
    letters = "abé東 \n\x00"
    passages = ["".join(rng.choices(letters, k=rng.randint(20, 90))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rng.choice([rng.choice(passages), "".join(rng.choices(letters, k=rng.randint(0, 60)))]) for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(parts)))
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(spark):
    rows = corpus(1)
    run = "=" * 400
    rows += [(1000, run), (1001, run), (1002, run[:70]), (1003, "ab" * 300), (1004, "ba" * 100), (1005, "x" * 49), (1006, "x" * 49), (1007, "x" * 50),
             (1008, "x" * 50), (1009, None), (1010, ""), (None, rows[0][1]), (None, "only here" * 20), (None, "only here" * 20), (5, "one id twice" * 9), (5, "one id twice" * 9)]
    check(spark, rows)


def test_small_chunks_buckets_and_long_documents(spark, monkeypatch):
    """Cut sizes change nothing: chunks of some documents, many buckets, transforms of few contexts."""
    monkeypatch.setattr(S, "CHUNK", 2000)
    monkeypatch.setattr(S, "BUCKET_BYTES", 1500)
    monkeypatch.setattr(S, "GROUP", 300)
    monkeypatch.setattr(S.common, "runs", lambda offsets, most=700, own=S.common.runs: own(offsets, 700))
    check(spark, corpus(2))


def test_documents_longer_than_a_run_of_anchors():
    rng = np.random.default_rng(1)
    text = rng.integers(97, 100, (1 << 24) + 5000, dtype=np.uint8)
    offsets = np.array([0, len(text)])
    doc, _, start, end, context, _ = S._entries(np.array([7]), offsets, text)
    covered = np.zeros(len(text) + 1, np.int64)
    np.add.at(covered, start, 1)
    np.add.at(covered, end, -1)
    assert (np.cumsum(covered[:-1]) > 0).all() and (doc == 0).all()


def test_a_passage_in_many_documents_with_distinct_edges(spark):
    """No anchor sends more contexts to its bucket than one transform takes."""
    rng = random.Random(4)
    edge = lambda: "".join(rng.choices("abcdefgh ", k=60))
    passage = "one passage that very many of the documents have in common, whatever stands around it; "
    rows = [(i, edge() + passage + edge()) for i in range(2500)]
    rows += [(3000, rows[7][1][:100] + edge()), (-1, passage[5:70]), (3001, passage[:60]), (None, edge() + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chunks = S._chunks(docs).cache()
    shared = S._shared(S._hashes(chunks, 2), 2)
    sent = {}
    for r in S._contexts(S._with(chunks, shared, "hashes"), 2).collect():
        for h, c in zip(S._unpack(r.hashes, np.uint32).tolist(), S._unpack(r.contexts, np.uint64).tolist(), strict=True):
            sent.setdefault((r.bucket, h), set()).add(c)
    chunks.unpersist()
    assert max(map(len, sent.values()), default=0) <= 1771
    check(spark, rows)


def test_empty(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_intervals_of_the_transform(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(1, 130))) for _ in range(20)] + [b"a" * 120, b"a" * 60]
    docs = np.array([rng.randint(0, 9) for _ in texts])
    least = {}
    for t, d in zip(texts, docs.tolist(), strict=True):
        for p in range(len(t) - L + 1):
            least[t[p:p + L]] = min(d, least.get(t[p:p + L], 99))
    for t, m in zip(texts, S.least_documents(texts, docs), strict=True):
        assert m.tolist() == [least[t[p:p + L]] for p in range(len(t) - L + 1)]


def test_the_statement_gives_the_same(spark):
    import duckdb

    from kinora.llm.queries import SQL
    rng = random.Random(21)
    parts = ["é" * 40, "x" * 60, "passage of more than fifty bytes that documents share, all of it ", "b", "東京" * 9, "0123456789" * 5]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 6)))) for i in range(40)] + [(7, "x" * 61), (7, None), (3, "x" * 61), (41, ""), (None, "é" * 40), (None, "of no other document " * 5)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cursor = con.execute(SQL["op4_suffix_dedup"])
    names = [c[0] for c in cursor.description]
    got = S.digest(S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))).select(*names).collect()
    assert sorted(map(tuple, got), key=str) == sorted(cursor.fetchall(), key=str)
