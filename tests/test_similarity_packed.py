"""Blocks packed by term, the choice between both products, and who can be settled."""

import numpy as np
import pandas as pd
import pytest
from test_similarity import brute_topk, corpus, reference_vectors

from kinora.operators import similarity


def vectors_of(spark, texts):
    return similarity.doc_vectors(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))


def with_copies():
    """Prose and a few groups of near copies, which alone can be settled."""
    texts = corpus(60)
    return texts | {7000 + 10 * g + c: " ".join(f"g{g}x{i}" for i in range(12)) + f" w{c}" for g in range(2) for c in range(6)}


@pytest.mark.parametrize("blocks", [2, similarity.COPIES + 1])
def test_few_settled_documents_leave_each_pair_to_be_scored_once(spark, monkeypatch, blocks):
    texts, asked = with_copies(), []
    for name in ("block_candidates", "crossed_candidates"):
        def spy(*args, f=getattr(similarity, name), **kw):
            asked.append(len(args) + len(kw))
            return f(*args, **kw)
        monkeypatch.setattr(similarity, name, spy)
    vec = vectors_of(spark, texts)
    assert 0 < similarity.rare_first(vec, 4)[0].count() < vec.count() / 2
    got = similarity.topk_neighbours(spark, vec, 4, blocks, settle=True).select("src", "dst", "rank").collect()
    assert asked == [3 if blocks <= similarity.COPIES else 2]  # without sources
    assert sorted(tuple(r) for r in got) == brute_topk(reference_vectors(texts), 4)


def test_only_documents_that_can_be_settled_are_joined(spark, monkeypatch):
    """Of one rare term and one other: six documents share the first, two others theirs."""
    stored = {}

    def spy(df, purpose, f=similarity.materialize):
        return stored.setdefault(purpose, f(df, purpose))
    rows = [(d, [1 if d < 6 else 2, 9], [0.8, 0.6], 1, 0.8, 0.6, 0.64 * (5 if d < 6 else 1)) for d in range(8)]
    vec = spark.createDataFrame(rows, "doc_id bigint, terms array<bigint>, weights array<double>, n_rare int, rare double, rest double, reach double")
    monkeypatch.setattr(similarity, "materialize", spy)
    settled, found = similarity.rare_first(vec, 4)
    assert {r.doc_id for r in settled.collect()} == set(range(6))
    assert {r.src for r in stored["rare-pairs"].select("src").distinct().collect()} == set(range(6))
    assert {(r.src, r.dst, r.q) for r in found.collect()} == {(a, b, 10 ** 9) for a in range(6) for b in range(6) if a != b}


def test_packed_blocks_hold_the_vectors(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 9, 20)
    pdf = pd.DataFrame({"doc_id": rng.permutation(20).astype(np.int64) - 7, "terms": [np.sort(rng.choice(30, s, replace=False)).astype(np.int64) for s in sizes],
                        "w": [rng.choice([1.5, 2.0, 3.25], s) for s in sizes], "norm": rng.random(20) + 1})
    monkeypatch.setattr(similarity, "MIN_BLOCK", 3)
    monkeypatch.setattr(similarity, "MAX_BLOCK", 8)
    found = {}
    for block in similarity._pack([pdf]):
        ids, p = similarity._unpack(block.add_suffix("_l").iloc[0], "l")
        assert list(ids) == sorted(ids) and (np.diff(p.terms) > 0).all()
        for d, t, w in zip(ids[p.rows], np.repeat(p.terms, p.sizes), p.weights):
            found.setdefault(int(d), {})[int(t)] = w
    assert found == {r.doc_id: dict(zip(r.terms.tolist(), r.w / r.norm)) for r in pdf.itertuples()}


@pytest.mark.parametrize("k", [1, 3, 100])
def test_top_of_rows_with_ties_and_own_documents(k):
    rng = np.random.default_rng(4)
    src, dst = rng.permutation(90)[:50].astype(np.int64), rng.permutation(90).astype(np.int64)
    scores = rng.choice([0.0, 0.0, 0.25, 0.25 + 2e-10, 0.5, 0.75], (50, 90))
    got = similarity._row_topk(scores, src, dst, k)
    want = []
    for i, a in enumerate(src):
        row = sorted((-round(s * 1e9), b) for s, b in zip(scores[i], dst) if s > 0 and a != b)
        want += [(a, b, -q) for q, b in row[:k]]
    assert sorted(got.itertuples(index=False, name=None)) == sorted(want)


def test_terms_of_all_sizes_give_the_same_scores(monkeypatch):
    """Dense columns, terms added on their own and the rest, in chunks."""
    rng = np.random.default_rng(5)
    def side(n):
        terms = [np.flatnonzero(rng.random(60) < np.linspace(0.02, 0.9, 60)) for _ in range(n)]
        return pd.DataFrame({"doc_id": np.arange(n), "terms": terms, "weights": [rng.random(len(t)) for t in terms]})
    left, right = side(40), side(30)
    dense = np.zeros((2, 60, 40))
    for at, pdf in enumerate((left, right)):
        for i, r in enumerate(pdf.itertuples()):
            dense[at, r.terms, i] = r.weights
    want = dense[0].T @ dense[1][:, :30]
    for name, value in (("DENSE", 2.0), ("OUTER", 40), ("PAIR_CHUNK", 10)):
        monkeypatch.setattr(similarity, name, value)
        assert np.allclose(similarity.score_block(left, right), want, atol=1e-12)
