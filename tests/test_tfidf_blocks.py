"""Counts and weights made by blocks of documents: what is shuffled, and odd ids."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinora.functions.stopwords import ENGLISH_STOP_WORDS
from kinora.operators import tfidf


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange " in x and "SinglePartition" not in x]


def rows():
    """Ids that repeat over partitions, null ids and texts, a text without terms."""
    texts = [f"Blue w{i % 7} glass w{i % 5} x{i} blue glass" for i in range(40)]
    return [(i % 30, t) for i, t in enumerate(texts)] + [(None, "blue stone"), (None, "stone blue stone"), (50, None), (51, ""), (52, "the of")]


def expected():
    counts = defaultdict(Counter)
    for i, t in rows():
        toks = [w for w in (t or "").lower().split() if w not in ENGLISH_STOP_WORDS]
        counts[i].update(toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])])
    return {i: c for i, c in counts.items() if c}


@pytest.fixture
def many_blocks(monkeypatch):
    monkeypatch.setattr(tfidf, "BLOCK_BYTES", 100)


def docs_of(spark):
    return spark.createDataFrame(rows(), "doc_id bigint, text string").repartition(6)


def test_counts_shuffle_texts_only(spark, many_blocks):
    got = tfidf.term_counts(docs_of(spark))
    assert not any("term" in x or "(doc_id" in x for x in exchanges(got))
    assert sorted((str(r.doc_id), r.term, r.tf_count) for r in got.collect()) == sorted(
        (str(i), t, n) for i, c in expected().items() for t, n in c.items())


def test_weights_shuffle_no_row_of_document_and_term(spark, many_blocks):
    docs = docs_of(spark)
    assert tfidf.in_blocks(docs)[1] > 8
    got = tfidf.tfidf_weights(docs)
    # by (doc, term), by term or by document nothing is dealt but texts and lists of a block's terms
    assert not any("term#" in x or "(doc_id" in x for x in exchanges(got))
    counts = expected()
    df, n = Counter(t for c in counts.values() for t in c), len(rows())
    want = {}
    for i, c in counts.items():
        w = {t: (1 + math.log(k)) * (math.log((1 + n) / (1 + df[t])) + 1) for t, k in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want |= {(i, t): x / norm for t, x in w.items()}
    found = {(r.doc_id, r.term): r.weight for r in got.collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-12 for k in want)


def test_shared_terms_have_one_number_in_all_blocks(spark, many_blocks):
    blocks, n = tfidf.in_blocks(docs_of(spark))
    found = tfidf.shared_terms(tfidf.block_counts(blocks), n).localCheckpoint().groupBy("term").agg(
        F.countDistinct("tid").alias("tids"), F.min("tid").alias("tid"), F.min("df").alias("low"), F.max("df").alias("high"), F.count("b").alias("blocks")).collect()
    df = Counter(t for c in expected().values() for t in c)
    assert {r.term: r.high for r in found} == {t: k for t, k in df.items() if k > 1}
    assert all(r.tids == 1 and r.low == r.high for r in found) and len({r.tid for r in found}) == len(found)
    assert max(r.blocks for r in found) > 1
