import random

import corpus_pipeline as P
import pytest
from test_decontaminate import distance
from test_minhash_dedup import plain as plain_groups
from test_pii import plain as plain_spans
from test_toxicity import corpus

from kinora.llm import toxicity as X
from kinora.llm.merge_dropout import codec_of


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with toxic ones, copies, benchmark passages and personal data."""
    at, rng = str(tmp_path_factory.mktemp("tables")), random.Random(8)
    rows = corpus(700)
    texts = [t for _, t, _ in rows]
    items = [" ".join(rng.choices(texts[0].split() + [f"q{j}" for j in range(200)], k=rng.randint(12, 40))) for _ in range(6)]
    for i in range(500, 540):  # near and exact copies
        words = texts[i % 7 + 20].split()
        if i % 2:
            words[rng.randrange(len(words))] = "copied"
        texts[i] = " ".join(words)
    for i in range(540, 560):
        texts[i] += " " + items[i % 6]
    for i in range(560, 600):
        texts[i] += f" mail a.{i}@example.org or +1 (555) 123-{i}0, 10.0.0.{i % 300}"
    docs = [(i, t, "en", "src", len(t)) for i, t in enumerate(texts)] + [(None, "without an id", "en", "s", 1), (900, None, None, None, None), (901, "", "", "", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 0, y) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, items


def test_each_stage_on_its_own_input(spark, tables):
    at, items = tables
    docs = spark.read.parquet(f"{at}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        out = P.materialize(stage(spark, docs, at), "test")
        before, after = ({(r.doc_id, r.text) for r in d.collect()} for d in (docs, out))
        seen[name] = len(before) - len(after)
        assert out.columns[:5] == columns and (out.columns == columns or name == "sentencepiece")
        if name == "toxicity":
            labels = spark.read.parquet(f"{at}/labels.parquet").where(X.remainder("doc_id") != 2)
            scores = X.score(docs, X.fit(docs, labels), "p").collect()
            assert after == {(r.doc_id, r.text) for r in scores if r.p < 0.3}
        elif name == "near_duplicates":
            kept = {i for i, _, _, k in plain_groups(list(before), 80) if k}
            assert after == {(i, t) for i, t in before if i is None or i in kept}
        elif name == "decontamination":
            def held(text):
                words = (text or "").lower().split()
                return any(distance(x.lower().split(), words) <= len(x.split()) * 20 // 100 for x in items)
            assert after == {(i, t) for i, t in before if not held(t)}
        elif name == "personal_data":
            assert {i for i, _ in after} == {i for i, _ in before}
            clean = {i for i, t in before if not plain_spans(t)}
            assert not any(plain_spans(t) for _, t in after) and len(clean) < len(before)
        else:
            assert after == before
            codec = codec_of(P.public_tokenizers.path("piece_bpe_32k.model"), 0, 0.0, 1)
            assert all((r.ids is None) == (r.text is None) and (r.ids is None or codec.decode(r.ids) == r.text) for r in out.collect())
        docs = out
    assert seen["toxicity"] > 80 and seen["near_duplicates"] > 20 and seen["decontamination"] > 5


def test_run_gives_the_last_stage(spark, tables):
    rows = P.run(spark, tables[0])
    assert rows.columns[-1] == "ids" and rows.where("doc_id = 901").count() == 1
