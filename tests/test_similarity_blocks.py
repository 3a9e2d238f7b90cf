"""The block product without copies of the vectors."""

import pytest
from test_similarity import brute_topk, corpus, reference_vectors

from kinora.operators import similarity


@pytest.mark.parametrize("settle", [False, True])
def test_many_blocks_are_not_copied(spark, monkeypatch, settle):
    monkeypatch.setattr(similarity, "MIN_BLOCK", 3)
    monkeypatch.setattr(similarity, "MAX_BLOCK", 7)
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    vec = similarity.doc_vectors(docs)
    nn = similarity.topk_neighbours(spark, vec, 4, similarity.COPIES + 1, settle).select("src", "dst", "rank")
    plan = nn._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "pi#" not in plan
    assert sorted(tuple(r) for r in nn.collect()) == brute_topk(reference_vectors(texts), 4)
