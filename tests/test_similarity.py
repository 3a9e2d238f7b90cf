"""TF-IDF weights and the block-pair top-K kernel against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from kinora.functions.stopwords import ENGLISH_STOP_WORDS
from kinora.operators import similarity, tfidf

STOP = set(ENGLISH_STOP_WORDS)
TOKEN = re.compile(r"(?u)\b\w\w+\b")


def reference_vectors(texts: dict[int, str]) -> dict[int, dict[str, float]]:
    """Plain-Python sublinear, smoothed, L2-normalised uni+bigram TF-IDF."""
    grams = {}
    for d, t in texts.items():
        toks = [w for w in TOKEN.findall(t.lower()) if w not in STOP]
        grams[d] = Counter(toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])])
    n = len(texts)
    df = Counter(g for c in grams.values() for g in c)
    out = {}
    for d, c in grams.items():
        w = {g: (1 + math.log(k)) * (math.log((1 + n) / (1 + df[g])) + 1) for g, k in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        out[d] = {g: x / norm for g, x in w.items()}
    return out


def brute_topk(vecs, k):
    ids = sorted(vecs)
    rows = []
    for a in ids:
        cands = []
        for b in ids:
            if a == b:
                continue
            s = sum(w * vecs[b].get(g, 0.0) for g, w in vecs[a].items())
            if s > 0:
                cands.append((-round(s * 1e9), b, s))
        cands.sort()
        for r, (q, b, s) in enumerate(cands[:k], start=1):
            rows.append((a, b, r))
    return sorted(rows)


def corpus(n=60, seed=7):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)]
    texts = {}
    for d in range(n):
        body = " ".join(rng.choice(words, size=rng.integers(1, 12)))
        texts[d * 3 + 1] = f"hot {body}" if d % 3 else body     # 'hot' is in two thirds of all docs
    texts[999] = "the of and"                                   # only stop words: no neighbours
    texts[1000] = texts[4]                                      # exact duplicate text
    return texts


def test_weights_match_reference(spark):
    texts = corpus(25)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    ref = reference_vectors(texts)
    got = tfidf.tfidf_weights(docs).collect()
    assert len(got) == sum(len(v) for v in ref.values())
    for r in got:
        assert abs(r.weight - ref[r.doc_id][r.term]) < 1e-12


@pytest.mark.parametrize("blocks", [1, 3, 5])
def test_topk_matches_brute_force(spark, blocks):
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    vec = similarity.doc_vectors(docs)
    got = similarity.topk_neighbours(spark, vec, 4, blocks).select("src", "dst", "rank").collect()
    assert sorted(tuple(r) for r in got) == brute_topk(reference_vectors(texts), 4)
    assert 999 not in {r.src for r in got}


def test_kernel_dense_and_sparse_paths_agree():
    rng = np.random.default_rng(1)
    def side(n):
        rows = []
        for i in range(n):
            terms = list({f"t{j}" for j in rng.integers(0, 30, size=rng.integers(1, 8))} | ({"hot"} if i % 2 else set()))
            w = rng.random(len(terms))
            rows.append({"terms": np.array(terms, dtype=object), "weights": w / np.linalg.norm(w)})
        return pd.DataFrame(rows)
    left, right = side(40), side(30)
    s = similarity.score_block(left, right)
    dense = np.zeros_like(s)
    for i, a in left.iterrows():
        for j, b in right.iterrows():
            wa = dict(zip(a.terms, a.weights))
            dense[i, j] = sum(wa.get(t, 0.0) * w for t, w in zip(b.terms, b.weights))
    assert np.allclose(s, dense, atol=1e-12)


def test_choose_blocks():
    assert similarity.choose_blocks(100, 8) == 1
    assert similarity.choose_blocks(3_000, 8) == 4          # 10 block pairs for 8 cores
    assert similarity.choose_blocks(10_000, 8) == 5         # 2048 documents per block at most
    assert similarity.choose_blocks(1000, 8, n_chars=60_000_000) == 10   # bounded by entries
    assert similarity.choose_blocks(1_000_000, 8) == math.ceil(1_000_000 / similarity.MAX_BLOCK)


def test_empty_blocks_change_nothing(spark):
    """One, two and five documents, and one without terms, over many blocks."""
    texts = ["red green blue", "red green stone", "blue stone glass", "glass glass red", "the of"]
    for n in (1, 2, 5):
        items = spark.createDataFrame(list(enumerate(texts[:n])), "movie_id long, feature_text string")
        one, *others = ([tuple(r) for r in similarity.content_neighbours(spark, items, 3, n_blocks=b).orderBy("movie_id", "rank").collect()]
                        for b in (1, 2, 17))
        assert all(o == one for o in others)
        assert len({r[:2] for r in one}) == len(one)


@pytest.mark.parametrize("k", [1, 4])
def test_settled_documents_match_brute_force(spark, k):
    """Groups of near copies settle on rare terms; prose of common words does not."""
    rng = np.random.default_rng(3)
    texts = corpus(50)
    for g in range(6):
        body = [f"g{g}x{i}" for i in range(12)]
        for c in range(6):
            texts[5000 + 10 * g + c] = " ".join(body[:int(rng.integers(8, 13))] + list(rng.choice([f"w{i}" for i in range(40)], 2)))
    texts |= {6000: "", 6001: "the of", 6002: texts[5000]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    vec = similarity.doc_vectors(docs)
    settled = similarity.rare_first(vec, k)[0].count()
    assert 0 < settled < vec.count()
    for blocks in (1, 3):
        got = similarity.topk_neighbours(spark, vec, k, blocks, settle=True).select("src", "dst", "rank").collect()
        assert sorted(tuple(r) for r in got) == brute_topk(reference_vectors(texts), k)


def test_all_documents_settled_or_none(spark):
    texts = {i: " ".join(f"a{i // 3}b{j}" for j in range(9)) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    vec = similarity.doc_vectors(docs)
    assert similarity.rare_first(vec, 2)[0].count() == 30
    got = similarity.topk_neighbours(spark, vec, 2, 2, settle=True).select("src", "dst", "rank").collect()
    assert sorted(tuple(r) for r in got) == brute_topk(reference_vectors(texts), 2)
    none = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    assert similarity.content_neighbours(spark, none, 3, "doc_id", "text", settle=True).count() == 0
