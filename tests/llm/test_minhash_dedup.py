import random
import re

import numpy as np
from pyspark.sql import functions as F

from kinora.llm import minhash_dedup as M
from kinora.llm.components import connected_components


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def plain(rows, least):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, s) in enumerate(sets):
        for j, t in sets[:x]:
            if s and t and 100 * len(s & t) >= least * len(s | t):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {(i, len(s), root(i), root(i) == i) for i, s in sets}


def corpus(seed, n=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, i = [], 0
    for _ in range(n):
        base = rng.choices(vocabulary, k=rng.randint(3, 160))
        for _ in range(rng.choice([1, 1, 2, 8])):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, rng.choice([" ", "\n"]).join(words).replace("w1", rng.choice(["w1", "W1"]))))
            i += 1
    rng.shuffle(rows)
    return rows


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, grp string")
    return M.near_duplicates(docs, **options).collect()


def test_matches_brute_force(spark):
    rows = corpus(1) + [(5000, ""), (5001, None), (5002, " \t"), (5003, "a b"), (5004, "A\u000bb"), (5005, "a b"), (5006, "x " * 20_000)]
    assert set(map(tuple, run(spark, rows))) == plain(rows, 85)


def test_cut_groups_lose_no_link(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):  # a hub whose copies are near it but not always near each other
        words = list(base)
        for _ in range(0 if i == 37 else rng.randint(1, 3)):
            words[rng.randrange(200)] = f"e{i}-{rng.randrange(99)}"
        rows.append((i, " ".join(words)))
    assert set(map(tuple, run(spark, rows, group_shingles=1500))) == plain(rows, 85)


def test_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(7, a), (7, a), (7, b), (9, b), (8, a), (None, a), (None, None)]
    got = sorted(map(tuple, run(spark, rows)), key=str)
    assert got == sorted([(7, 46, 7, True)] * 3 + [(9, 46, 7, False), (8, 46, 7, False), (None, 46, None, True), (None, 0, None, True)], key=str)


def test_empty(spark):
    assert run(spark, []) == []


def test_forest_of_links_is_exact():
    rng = np.random.default_rng(2)
    for _ in range(30):
        base = rng.integers(0, 2**63, 60, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, 52, replace=False), rng.integers(0, 2**63, rng.integers(0, 4), dtype=np.uint64)])) for _ in range(25)]
        n = len(sets)
        near = lambda i, j: 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
        pairs = [(i, j) for i in range(n) for j in range(i) if near(i, j)]
        found = M.linked(sets, 85)
        assert all(near(i, j) for i, j in found)

        def parts(edges):
            name = list(range(n))
            for _ in range(n):
                for i, j in edges:
                    name[i] = name[j] = min(name[i], name[j])
            return name
        assert parts(pairs) == parts(found)


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    name = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            name[a] = name[b] = min(name[a], name[b])
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in name.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_banding_follows_the_similarity():
    assert M.banding(85) == (10, 3) and M.banding(80) == (14, 3)
    for least in range(1, 101):
        tables, rows = M.banding(least)
        assert 1 - (1 - (1 - (least / 100) ** rows) ** tables) ** 2 <= M.MISS


def test_pairs_at_a_lower_threshold_meet(spark):
    """Pairs of similarity 0.8 exactly: 45 shingles each, 40 in both."""
    rows = []
    for i in range(3000):
        words = [f"{i}x{k}" for k in range(49)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:24], "other", *words[25:]]))]
    assert sum(not r.kept for r in run(spark, rows, least=80)) >= 2999


def test_only_bundles_that_others_share_become_keys(spark):
    """Ties are those of all pairs of bundles, and a document that no other is like makes no key."""
    rows = corpus(9) + [(9000 + i, " ".join(f"{i}y{k}" for k in range(30))) for i in range(200)]
    sig = M.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 10, 3).withColumn("rep", F.col("doc_id")).localCheckpoint()
    bundles = {(r.rep, r.n_shingles): ([*enumerate(r.a)], [*enumerate(r.b)]) for r in sig.collect() if r.rep is not None and r.n_shingles}
    buckets = {}
    for (rep, _), (a, b) in bundles.items():
        for x in a:
            for y in b:
                buckets.setdefault((x, y), set()).add(rep)
    ties = {(i, min(own)) for own in buckets.values() for i in own if i > min(own)}
    assert ties and {tuple(r) for r in M._ties(sig).collect()} == ties
    shared = [r.rep for r in M._shared(sig).collect()]
    assert {i for t in ties for i in t} <= set(shared) and max(shared) < 9000


def test_a_repeated_id_makes_keys_in_proportion(spark):
    """Many texts of one doc_id and copies of one row: each text has keys of its own bundles only."""
    texts = [" ".join(f"{i}z{k}" for k in range(30)) for i in range(50)]
    rows = [(1, t) for t in texts] + [(2, t) for t in texts] + [(3, texts[0])] * 20
    sig = M.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 10, 3).withColumn("rep", F.col("doc_id"))
    assert sorted((r.rep, len(r.a), len(r.b)) for r in M._shared(sig).collect()) == [(1, 10, 10)] * 50 + [(2, 10, 10)] * 50 + [(3, 10, 10)]
