import random
import re

import numpy as np
import pytest
import xxhash

from kinora.llm import simhash as S


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, errors=4):
    found = [(i, plain_fingerprint(t)) for i, t in rows]
    parent = {i: i for i, _ in found if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for x, (i, f) in enumerate(found):
        for j, g in found[:x]:
            if i is not None and j is not None and (f ^ g).bit_count() <= errors:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {(i, f"{f:016x}", None if i is None else root(i)) for i, f in found}


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, shard string, rep int")
    return list(map(tuple, S.simhash_components(docs, **options).collect()))


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary, rows = [f"w{i}é" for i in range(900)], []
    for _ in range(n):
        base = rng.choices(vocabulary, k=rng.randint(1, 300))
        for _ in range(rng.choice([1, 1, 2, 9])):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows), rng.choice([" ", "\n", "\u000b "]).join(words).replace("w1", rng.choice(["w1", "W1"]))))
    rng.shuffle(rows)
    return rows


CASES = [(5000, ""), (5001, None), (5002, " \t"), (5003, "a b"), (5004, "A\u000bb"), (5005, "a b c d"), (5006, "x " * 90_000),
         (None, "a b"), (None, None), (5007, "ÄÖ ü ß \U0001f600"), (5008, "one text"), (5008, "another text of this id"), (5009, "One text"), (5010, "another text of this id")]


def test_matches_brute_force(spark):
    rows = corpus(3) + CASES
    got = run(spark, rows)
    assert len(got) == len(rows) and set(got) == plain(rows)


def test_cut_shards_lose_no_link(spark):
    rows = corpus(4, 30) + CASES
    assert set(run(spark, rows, shard=3)) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, "a b c d")])[0][2] is None


def roots(n, edges):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in edges:
        x, y = sorted((root(int(a)), root(int(b))))
        parent[y] = x
    return [root(i) for i in range(n)]


def dense(rng, n, spread):
    """Values near a few centres: long chains and balls of small distances."""
    centres = rng.integers(0, 1 << 64, 5, dtype=np.uint64)
    out = centres[rng.integers(0, 5, n)]
    for _ in range(spread):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)) * (rng.random(n) < 0.6)
    return np.unique(out)


@pytest.mark.parametrize(("errors", "spread"), [(4, 3), (4, 7), (2, 4), (0, 1), (7, 9)])
def test_rotations_and_budgets_find_every_component(errors, spread):
    rng = np.random.default_rng(errors * 10 + spread)
    values = dense(rng, 700, spread)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= errors
    want = roots(len(values), [(a, b) for a, b in np.argwhere(near) if a < b])
    edges = []
    for i in range(errors + 1):
        by = sum(S.block_widths(errors)[:i])
        turned = values if not by else values << np.uint64(by) | values >> np.uint64(64 - by)
        order = np.argsort(turned)
        for a, b in S.trie_links(turned[order], S.budgets(errors, i), errors, pairs=64):
            x, y = order[a], order[b]
            assert (np.bitwise_count(values[x] ^ values[y]) <= 64).all()
            edges += zip(x, y, strict=True)
    got = roots(len(values), edges)
    assert got == want


def test_a_rotation_always_keeps_the_budget():
    rng = random.Random(7)
    for _ in range(3000):
        at = rng.sample(range(64), rng.randint(0, 4))
        x = sum(1 << 63 - b for b in at)
        fits = []
        for i in range(5):
            by = sum(S.block_widths(4)[:i])
            y = (x << by | x >> 64 - by) & (1 << 64) - 1
            limit = S.budgets(4, i)
            fits.append(all((y >> 64 - d).bit_count() <= limit[d] for d in range(1, 65)))
        assert any(fits)
