import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from kinora.llm import filter_audit as A


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {name for name, bad in (("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)),
                                   ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), ("D", bool(re.search("[#$%&*|]", text)))) if bad}


def plain(docs, labels):
    """Every order applied to the documents one by one."""
    rows = []
    for doc_id, text, source in docs:
        smaller = [i for i, t, _ in docs if i is not None and (t or "") == (text or "")]
        own = fails(text or "") | ({"E"} if doc_id is not None and doc_id > min(smaller) else set())
        mine = [x for x in labels if doc_id is not None and x[0] == doc_id]
        rows.append((source or "", own, any(q == 1 for _, q, _ in mine), any(t == 1 for _, _, t in mine)))
    out, shapley = {}, {}
    for part in {p for p, *_ in rows}:
        for order in map("".join, permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, order, step] = [len(left), len(here), sum(f in r[1] for r in gone), sum(r[0] == part and r[1] == {f} for r in rows),
                                          sum(r[2] for r in here), sum(r[3] for r in here)]
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                gone += here
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(spark, docs, labels):
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 as mask", "2 as part", "3 as first", "4 as same")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "5 as good")
    return list(map(tuple, A.filter_audit(docs, labels).collect()))


def test_matches_every_order_applied(spark):
    long = " ".join(f"word{i}" for i in range(60))
    docs = [(1, long, "a"), (2, long, "a"), (3, long, "b"), (4, "Few WORDS", "a"), (5, long + " #", "a"), (6, "same " * 80, "a"),
            (7, long.upper(), "b"), (8, None, None), (9, "", "b"), (9, "", "b"), (10, " \t\n", "a"), (None, long, "a"), (None, None, "b"),
            (3, long, "c"), (11, "x " * 200_000 + "|", "b"), (12, "Äß\u000b\U0001f600 É", None), (0, "Few WORDS", "b"), (13, " ".join(["AB"] * 70), "c")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (4, 1, 1), (5, None, 1), (7, 1, None), (None, 1, 1), (8, 1, 0), (99, 1, 1), (11, 1, 1)]
    got = run(spark, docs, labels)
    assert len(got) == len(set(got)) == 4 * 600
    assert set(got) == plain(docs, labels)


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert len(run(spark, [(1, "a", "s")], [])) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_least_squares_gives_the_mean_over_orders(n):
    for i, row in enumerate(A.shapley_solution(n)):
        for s, factor in enumerate(row):
            k = s.bit_count()
            inside = Fraction(factorial(k - 1) * factorial(n - k), factorial(n)) if s >> i & 1 else 0
            outside = -Fraction(factorial(k) * factorial(n - k - 1), factorial(n)) if k < n and not s >> i & 1 else 0
            if k:
                assert factor == inside + outside


def test_names_are_checked(spark):
    with pytest.raises(ValueError):
        A.filter_audit(None, None, repeated="A")
