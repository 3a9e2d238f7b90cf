"""Counts and weights of a block with Arrow and NumPy, against expressions and plain Python."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinora.operators import term_blocks, tfidf

ODD = ["Blue glass, blue_glass STONE", "x7 x 7x été İstanbul ΣΣΣ 中文 中 ٤٥ ⅫⅬ x²", "áb́cd ef", "\U00010400\U00010401 \U0001f600\U0001f600 ok",
       "\u0870\u0871a ბა\u1c90Ა q\u2c2fz", "the of and", "", "  ...  ", "one red two red", "tab\tline\nend\r\nred-red", "red red red", None]


def table(rows):
    return pa.table({"b": pa.array([3] * len(rows), pa.int32()), "doc_id": pa.array([i for i, _ in rows], pa.int64()),
                     "text": pa.array([t for _, t in rows], pa.string())})


def counts_of(c):
    strings = term_blocks.term_strings(c.words, c.terms).to_pylist()
    term = np.repeat(np.arange(len(c.terms)), c.n)
    return {(c.ids[d].as_py(), strings[t]): int(n) for d, t, n in zip(c.doc, term, c.count)}


@pytest.mark.parametrize("ngram_max", [1, 2])
def test_counts_are_those_of_the_expressions(spark, ngram_max):
    """Null and repeated ids, letters of several scripts, marks, digits, texts without terms."""
    rows = [(i % 9 if i != 3 else None, t) for i, t in enumerate(ODD)] + [(None, "stone blue glass")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    low = [(r.doc_id, r.low) for r in docs.select("doc_id", tfidf.spaced(F.col("text")).alias("low")).collect()]
    t = table(low)
    want = {(r.doc_id, r.term): r.tf_count for r in tfidf.term_counts(docs, ngram_max=ngram_max).collect()}
    assert counts_of(term_blocks.count_block(t["doc_id"], t["text"], ngram_max)) == want


def test_numbers_too_large_for_one_key(monkeypatch):
    words = [f"w{i}" for i in range(300)]
    t = table([(d, " ".join(words[(7 * d + j) % 300] for j in range(40))) for d in range(60)])
    want = term_blocks.count_block(t["doc_id"], t["text"])
    monkeypatch.setattr(term_blocks, "MOST", 1000)
    got = term_blocks.count_block(t["doc_id"], t["text"])
    assert counts_of(got) == counts_of(want) and (np.diff(got.terms) > 0).all()


def test_frequencies_come_back_in_the_order_of_any_row_order():
    """Blocks of the same texts in another order find the same numbers."""
    blocks = [[(10 * b + i, f"blue w{i % 3} glass x{b} blue") for i in range(7)] for b in range(4)]
    lists = [term_blocks.term_lists(5, 2)(table(rows)) for rows in blocks]
    lists = pa.concat_tables([x.set_column(0, "b", pa.array([b] * len(x), pa.int32())) for b, x in enumerate(lists)])
    found = pa.concat_tables([term_blocks.frequencies()(lists.filter(pa.compute.equal(lists["p"], p))) for p in range(5)])
    df = defaultdict(set)
    for rows in blocks:
        t = table(rows)
        for d, term in counts_of(term_blocks.count_block(t["doc_id"], t["text"])):
            df[term].add(d)
    for b, rows in enumerate(blocks):
        t = table(rows[::-1])
        c = term_blocks.count_block(t["doc_id"], t["text"])
        own = found.filter(pa.compute.equal(found["b"], b))
        got, _ = term_blocks.frequencies_in(c, 5, own)
        assert got.tolist() == [len(df[s]) for s in term_blocks.term_strings(c.words, c.terms).to_pylist()]
    other = table(blocks[0][:-1] + [(6, "unknown stones")])
    with pytest.raises(ValueError, match="differ"):
        term_blocks.frequencies_in(term_blocks.count_block(other["doc_id"], other["text"]), 5, found.filter(pa.compute.equal(found["b"], 0)))


def test_weights_are_made_without_a_row_of_document_and_term_in_the_plan(spark, monkeypatch):
    """No aggregate, sort, join or window goes over (document, term) rows; batches are cut."""
    monkeypatch.setattr(tfidf, "BLOCK_BYTES", 200)
    monkeypatch.setattr(term_blocks, "SLICE", 7)
    docs = spark.createDataFrame([(i % 25, t) for i, t in enumerate(ODD * 4)], "doc_id bigint, text string").repartition(3)
    got = tfidf.tfidf_weights(docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Generate", "Window", "SortMergeJoin", "regexp_extract_all"))
    rows = got.collect()
    assert Counter((r.doc_id, r.term) for r in rows) == Counter((r.doc_id, r.term) for r in tfidf.term_counts(docs).collect())
    norms = defaultdict(float)
    for r in rows:
        norms[r.doc_id] += r.weight ** 2
    assert all(abs(x - 1) < 1e-12 for x in norms.values())
