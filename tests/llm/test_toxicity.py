import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from kinora.llm import common
from kinora.llm import toxicity as X

DOCS, LABELS = "doc_id long, text string, score string", "doc_id long, toxic int"


def corpus(n, seed=3):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = rng.choices(plain, k=rng.randint(5, 120))
        for _ in range(1 + len(words) // 40 if toxic else 0):  # a stem with any ending
            words[rng.randrange(len(words))] = rng.choice(["zorgle", "vexmu"]) + rng.choice(plain)
        rows.append((i, " ".join(words), toxic))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    model = X.fit(docs, labels.where(X.remainder("doc_id") != 2))
    got = {r.doc_id: r.p for r in X.score(docs.select("doc_id", "text"), model, "p").collect()}
    held = [(got[i] >= 0.3, y == 1) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= p <= 1 for p in got.values())


def test_no_ngram_is_left_out_of_a_large_model(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(1000)), i % 2) for i in range(140)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    counted = labels.where("pmod(xxhash64(doc_id, 1), 4) <> 3").join(docs, "doc_id").select("text").collect()
    data, offsets = common.utf8(pa.array([r.text for r in counted]))
    starts, lengths, _, _ = X.word_bytes(data, offsets)
    every = np.unique(X.ngram_keys(data, starts, lengths)[1])
    assert len(every) > 600_000 and np.array_equal(X.fit(docs, labels).keys, every)


def test_odd_rows(spark):
    rows = corpus(400)
    odd = [(None, None, None), (7000, "", None), (7001, "1234 !!", None), (7002, "zorgleabc " * 20_000, None), (7003, "same", None), (7003, "same", None)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows + odd], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (4, 7), (7003, 0)], LABELS)
    out = X.score(docs, X.fit(docs, labels), "p")
    assert out.columns == ["doc_id", "text", "score", "p"]
    got = out.collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r.p for r in got}
    assert by[7002] > 0.9 and by[7000] == by[None] == by[7001] < 0.3


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "")], DOCS)
    labels = spark.createDataFrame([(1, 1)], LABELS)
    assert [r.p for r in X.score(docs, X.fit(docs, labels), "p").collect()] == [0.0]
    none = docs.limit(0)
    assert X.score(none, X.fit(none, labels), "p").collect() == []


def test_kneser_ney_against_plain_counts(spark):
    """The tables against the formulas over dictionaries of byte strings, all orders."""
    rng = random.Random(11)
    texts = [" ".join("".join(rng.choices("abc", k=rng.randint(1, 15))) for _ in range(12)) for _ in range(6)] + ["ab abc ba b", "cab \u00e9t\u00e9"]
    toxic = [1, 0, 0, 1, 0, 0, 1, 0]
    data, offsets = common.utf8(pa.array(texts))
    starts, lengths, doc, _ = X.word_bytes(data, offsets)
    word, keys_of, contexts_of = X.ngram_keys(data, starts, lengths)
    grams = []
    for s, n in zip(starts, lengths, strict=True):
        w = b" " + data[s:s + n].tobytes() + b" "
        grams += [w[max(0, i - X.ORDER + 1):i + 1] for i in range(1, len(w))]
    assert len(grams) == len(word)
    _, head, tail = X.ngram_bytes(data, starts, lengths)
    assert [(int(h) << 64 | int(t)).to_bytes(16, "big").lstrip(b"\0") for h, t in zip(head, tail, strict=True)] == grams
    parts = sorted({g[i:] for g in set(grams) for i in range(len(g) - 1)})  # all n-grams of two bytes and more
    before = Counter(p[1:] for p in parts)

    def shared(s):
        if not s:
            return 1 / 155
        of = [n for x, n in before.items() if x[:-1] == s[:-1]]
        return (max(before[s] - .75, 0) + .75 * len(of) * shared(s[1:])) / sum(of)

    docs = spark.createDataFrame(list(zip(texts, toxic, strict=True)), "text string, toxic int")
    keys, values, contexts, backoff = X._tables(X._count(docs))
    assert len(keys) == len(set(grams)) and len(contexts) == len({g[:-1] for g in grams})
    y = np.array(toxic)[doc][word]
    counts = [Counter(x for x, d in zip(grams, y, strict=True) if d == k) for k in (1, 0)]
    for i, g in enumerate(grams):
        p, rest = [], []
        for c in counts:
            total = sum(n for x, n in c.items() if x[:-1] == g[:-1])
            free = .75 * sum(x[:-1] == g[:-1] for x in c) / total if total else 1
            p.append((max(c[g] - .75, 0) / total if total else 0) + free * shared(g[1:]))
            rest.append(free)
        assert abs(values[np.searchsorted(keys, keys_of[i])] - np.log(p[0] / p[1])) < 1e-5
        assert abs(backoff[np.searchsorted(contexts, contexts_of[i])] - np.log(rest[0] / rest[1])) < 1e-5
    single = X.single_bytes(np.array([p[0] * 256 + p[1] for p in parts if len(p) == 2]))
    assert abs(single[np.unique(X._LOW)].sum() - 1) < 1e-12 and X.SYMBOLS == 155


def test_the_sample_is_bounded_in_bytes(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    size = {i: len(t) for i, t, _ in rows}
    order = [r.doc_id for r in labels.where("toxic = 0").selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h", "doc_id").collect()]
    want, total = set(), 0
    for i in order:
        if total < 5000:
            want.add(i)
        total += size[i]
    got = {r.doc_id for r in X._texts(docs, labels.where("toxic = 0"), 5000).collect()}
    assert got == want and 3 < len(got) < len(order)
    assert {r.doc_id for r in X._texts(docs, labels, 1 << 40).collect()} == set(size)


def test_all_labelled_rows_are_learned_from(spark):
    """More rows of a class than the sample held before: none is left out."""
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)), int(i % 10 == 0)) for i in range(7000)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    counted = labels.where("pmod(xxhash64(doc_id, 1), 4) <> 3").join(docs, "doc_id").select("text", "toxic").collect()
    assert sum(not r.toxic for r in counted) > 4000
    data, offsets = common.utf8(pa.array([r.text for r in counted]))
    starts, lengths, _, _ = X.word_bytes(data, offsets)
    assert np.array_equal(X.fit(docs, labels).keys, np.unique(X.ngram_keys(data, starts, lengths)[1]))


def test_words_meet_their_ngrams(spark, tmp_path, monkeypatch):
    """Scores from the blocks' files against plain lookups in the whole tables."""
    monkeypatch.setattr(X, "RUN_ROWS", 3)
    monkeypatch.setattr(X, "BLOCK_ROWS", 7)
    rng = random.Random(9)
    words = ["".join(rng.choices("ab\u00e9C", k=rng.choice([1, 2, 3, 4, 9, 10, 11, 12, 13, 30]))) for _ in range(150)]
    seen = [(i, " ".join(rng.choices(words[:100], k=20)), i % 2) for i in range(30)]
    texts = ["", "12", *[" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(60)]]
    tables = X.materialize(X._estimated(X._count(spark.createDataFrame(seen, "doc_id long, text string, toxic int"))), "test")
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "_block long, text string").repartition(3).write.parquet(f"{tmp_path}/docs")
    got = X.score(spark.read.parquet(f"{tmp_path}/docs"), X.Model(tables, np.array([1.0, 0, 0])), "p")
    assert got.columns == ["_block", "text", "p"]
    arrays, by = X._arrays(tables), {r["_block"]: r.p for r in got.collect()}
    for i, text in enumerate(texts):
        starts, lengths, _, _ = X.word_bytes(*(run := common.utf8(pa.array([text]))))
        _, key, context = X.ngram_keys(run[0], starts, lengths)
        want = X._found(*arrays, key, context).sum() / max(1, len(key))
        assert abs(by[i] - 1 / (1 + np.exp(-want))) < 1e-7


def test_learning_and_scoring_in_one(spark):
    rows = corpus(300)
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows] + [(None, "no id", None), (3, None, None)], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], LABELS)
    one, two = X.fit_score(docs, labels, "p"), X.score(docs, X.fit(docs, labels), "p")
    assert one.columns == two.columns == ["doc_id", "text", "score", "p"]
    a, b = (sorted((r.doc_id or -1, r.text or "", r.p) for r in x.collect()) for x in (one, two))
    assert [r[:2] for r in a] == [r[:2] for r in b] and max(abs(x[2] - y[2]) for x, y in zip(a, b, strict=True)) < 1e-9
