import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from kinora.llm import conversation_trie as C


def plain(rows):
    """Every prefix in a dictionary."""
    def key(row):
        role, text = row[2] or "", row[3] or ""
        return row[1] is not None, row[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(np.fmod(c, 20)), [])[:h] + turns[h:])
    nodes = {s[:d] for s in whole.values() for d in range(len(s) + 1)}
    member = {x: sorted(c for c, s in whole.items() if s[:len(x)] == x) for x in nodes}
    children = {x: [y for y in nodes if len(y) == len(x) + 1 and y[:-1] == x] for x in nodes}

    def words(x):
        return len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0
    out = set()
    for x in nodes:
        below = [y for y in nodes if y[:len(x)] == x]
        ends = ",".join(str(c) for c in member[x] if whole[c] == x)
        out.add((member[x][0], len(x), member[x[:-1]][0] if x else None, len(member[x]), len(children[x]), sum(not children[y] for y in below),
                 sum((len(member[y]) - 1) * words(y) for y in below), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as depth", "2 as n", "3 as seg", "4 as key1")
    return list(map(tuple, C.conversation_trie(df.repartition(3), **options).collect()))


def talk(seed, n=70, longest=9):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-20, 400), n):
        for turn in range(rng.choice([1, 2, rng.randint(1, longest)])):
            rows.append((c, rng.choice([turn, turn, None]) if turn == 0 else turn, rng.choice(["user", "user", None, "é"]),
                         rng.choice(["hi there", "hi there", "a b\u000bc", None, "", " \t", "long " * 30, f"own {c}"])))
    return rows + [(None, 1, "user", "nobody")] + [(100, 5, "user", "again")] * 3 + [(120, 1, "x", "a")] + [(121, 1, "x", "b")]


@pytest.mark.parametrize("options", [{}, {"size": 3, "most": 7, "run_ids": 2}, {"size": 1, "most": 1}])
def test_matches_a_dictionary_of_prefixes(spark, options):
    rows = talk(5)
    got = run(spark, rows, **options)
    assert len(got) == len(set(got)) and set(got) == plain(rows)


def test_copies_and_a_long_conversation(spark):
    rng = random.Random(6)
    line = [(t, rng.choice(["user", "bot"]), rng.choice(["yes", "no", "yes it is"])) for t in range(300)]
    rows = [(c, *x) for c in (7, 40, 41, 60) for x in line[:rng.choice([130, 300])]] + [(c, t, "user", "same") for c in range(200, 260) for t in range(3)]
    assert set(run(spark, rows, size=8)) == plain(rows)


def test_without_conversations_or_turns(spark):
    assert run(spark, []) == run(spark, [(None, 1, "a", "b")]) == []
    short = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    assert set(run(spark, [(short, 1, "user", "gone")])) == plain([(short, 1, "user", "gone")]) == {
        (short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())}


@pytest.mark.parametrize("seed", range(4))
def test_double_array_holds_its_sequences_only(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 7, 400)
    starts = np.cumsum(lengths) - lengths
    codes = rng.integers(0, [2, 9, 300, 5000][seed], lengths.sum())
    trie = C.DoubleArray(codes, starts, lengths)
    slots = trie.walk(codes, starts, lengths)
    held = {tuple(codes[a:a + d + 1]): int(slots[a + d]) for a, n in zip(starts, lengths, strict=True) for d in range(n)}
    assert (slots > 0).all() and len(set(held.values())) == len(held)
    assert (np.flatnonzero(trie.check >= 0)[1:].tolist()) == sorted(held.values())
    for _ in range(300):  # others leave the trie where no held prefix goes on
        other = tuple(rng.integers(0, [2, 9, 300, 5000][seed], 4).tolist())
        got = trie.walk(np.array(other), np.array([0]), np.array([4]))
        assert got.tolist() == [held.get(other[:d + 1], -1) for d in range(4)]
