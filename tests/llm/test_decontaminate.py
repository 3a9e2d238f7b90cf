import random

import numpy as np
import pyarrow as pa

from kinora.llm import common
from kinora.llm import decontaminate as D

DOCS, ITEMS = "doc_id long, text string, items string", "item_id long, text string"
WORDS = [f"w{i}" for i in range(800)]


def distance(item, text):
    """Least edits of the item's words to any part of the text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = rng.choice(WORDS)
        elif kind == 1:
            words.insert(at, rng.choice(WORDS))
        elif len(words) > 1:
            del words[at]
    return words


def corpus(seed):
    rng = random.Random(seed)
    items = [rng.choices(WORDS, k=rng.randint(5, 60)) for _ in range(25)]
    docs = []
    for i in range(200):
        words = rng.choices(WORDS, k=rng.randint(0, 80))
        for _ in range(rng.choice([0, 0, 1, 2])):
            item = rng.choice(items)
            at = rng.randint(0, len(words))
            words[at:at] = edited(rng, item, rng.randint(0, len(item) // 4))
        docs.append((i, " ".join(words).replace("w1", rng.choice(["w1", "W1"])), "clash"))
    return docs, [(100 - i, " ".join(x)) for i, x in enumerate(items)]


def plain(docs, items):
    return {i: sorted(k for k, x in items if x and len(x.split()) >= 5 and text and
                      distance(x.lower().split(), text.lower().split()) <= len(x.split()) * 20 // 100) for i, text, _ in docs}


def test_matches_brute_force(spark):
    docs, items = corpus(1)
    got = D.flag(spark.createDataFrame(docs, DOCS).withColumnRenamed("items", "n.m"), spark.createDataFrame(items, ITEMS), "items").collect()
    want = plain(docs, items)
    assert sum(map(len, want.values())) > 80
    assert {r.doc_id: r.items for r in got} == want


def test_blocks_and_odd_rows(spark):
    docs, items = corpus(2)
    items += [(500, None), (501, ""), (502, "w1 w2"), (None, items[0][1]), (503, items[0][1])]
    docs += [(900, None, ""), (901, "", ""), (902, items[0][1], ""), (902, items[0][1], ""), (903, items[3][1] + " word" * 50_000, "")]
    got = D.flag(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), "held", block_words=60).collect()
    assert len(got) == len(docs)
    want = plain(docs[:-1], [x for x in items if x[0] is not None]) | {903: [items[3][0]]}
    assert {r.doc_id: r.held for r in got} == want


def test_empty(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f", "")], DOCS), spark.createDataFrame([], ITEMS)
    assert [r.held for r in D.flag(docs, items, "held").collect()] == [[]]
    assert D.flag(docs.limit(0), items, "held").collect() == []


def test_recall_of_the_sampled_walks():
    """Keys alone, at the most edits allowed, over windows of the items' sizes."""
    rng = random.Random(3)
    items = [rng.choices(WORDS, k=rng.randint(15, 60)) for _ in range(150)]
    known = D.Items(list(range(150)), [" ".join(x) for x in items], 80, 5)
    hits = total = 0
    for k, item in enumerate(items):
        for edits in (0, int(known.edits[k])):
            h, d = common.words(*common.utf8(pa.array([" ".join(edited(rng, item, edits) + rng.choices(WORDS, k=20))])))
            keys = known.embed(h, np.array([0]), np.array([len(h)]), np.array([k]))
            near = bool((keys[0] == known.keys[k]).any())
            assert near or edits
            hits, total = hits + near * (edits > 0), total + (edits > 0)
    assert hits / total >= 0.95


def test_short_items_are_found_by_their_words(spark):
    docs, items = corpus(4)
    items += [(600, docs[3][1].split()[0]), (601, "w1 W2"), (602, "w1 w2"), (603, "no such words here"), (604, ""), (605, "all of the text")]
    items += [(700 + i, " ".join(docs[i][1].split()[2:2 + i % 5])) for i in range(40)]
    docs += [(950, "All of\nthe  text", ""), (951, "all of the", ""), (952, "text", "")]
    got = D.flag(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), "held", min_words=1, block_words=60).collect()
    want = {i: sorted(k for k, x in items if x and distance(x.lower().split(), text.lower().split()) <= len(x.split()) * 20 // 100) for i, text, _ in docs}
    assert {r.doc_id: r.held for r in got} == want and want[950] == [605]


def test_the_query_and_the_stage_search_short_items(spark, tmp_path):
    import corpus_pipeline
    from kinora.llm.queries import QUERIES
    docs = spark.createDataFrame([(1, "it holds four short words there"), (2, "it does not")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "four short words")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id: r["items"] for r in QUERIES["op9_decontaminate"](spark, str(tmp_path)).collect()} == {1: "7", 2: ""}
    assert [r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()] == [2]


def test_a_task_gives_back_what_it_has_freed(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c", "")], DOCS)
    monkeypatch.setattr(common, "extended", lambda df, made, **added: made(str))
    run = D.flag(docs, spark.createDataFrame([(5, "b c")], ITEMS), "_items", min_words=1)
    released = []
    monkeypatch.setattr(common, "release", lambda: released.append(1))
    monkeypatch.setattr(common, "_CLAIMED", [None, None])
    out = list(run(iter([pa.RecordBatch.from_pydict({"text": ["a b c", "c b", None]})])))
    assert [b.column(1).to_pylist() for b in out] == [[[5], [], []]] and released == [1]
