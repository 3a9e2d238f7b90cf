"""Audit of how quality filters interact: what each removes in every order.

A document's failures are a bit mask, one bit a filter, and per part of the corpus the
documents of each mask are counted.  From these at most ``2 ** n`` counts follow the
removals of every coalition of filters, ``v(S)``: the documents that fail any of S.

* Steps: the filter ``f`` after the filters ``P`` removes ``v(P + f) - v(P)``.
* Shapley values solve the least squares of KernelSHAP: the values of the filters in S
  should sum to ``v(S)``, weighted by ``(n - 1) / (C(n, |S|) |S| (n - |S|))``, and all of
  them must sum to ``v(all)``.  The normal equations with that constraint are solved
  once in rationals for every coalition's unit vector (``shapley_solution``), so a
  part's values are an exact integer combination of its removals.

Everything but that small solution is DataFrame work: one pass reads the texts and
writes narrow rows; the first document of each text comes from a partial aggregate, is
joined back by text and doc_id (a key that hardly repeats, however many copies a text
has), and all parts are tabulated in one aggregate of few rows.

Cases: a null text is empty (it has no words, so it fails A, and equals other empty
texts); a null part is the empty string; a document without labels is neither good nor
toxic, and one of several label rows counts if any row says so.  Texts are compared by
SHA-256.  A null doc_id is never a repetition and never the smaller one; rows that
repeat the smallest doc_id of a text are not repetitions.  An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinora.session import materialize

SPACE = r"[\x20\x09-\x0D]+"


def shapley_solution(n: int) -> list[list[Fraction]]:
    """Per filter the factor of every coalition's removals (index: the coalition's bits)
    in its Shapley value, by the constrained normal equations."""
    every = range(1 << n)
    rows = [[Fraction(0)] * (n + 1 + len(every)) for _ in range(n + 1)]
    for s in every:
        k = s.bit_count()
        if 0 < k < n:
            weight = Fraction(n - 1, math.comb(n, k) * k * (n - k))
            inside = [i for i in range(n) if s >> i & 1]
            for i in inside:
                for j in inside:
                    rows[i][j] += weight
                rows[i][n + 1 + s] += weight
    for i in range(n):  # the values sum to what all filters remove
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + (1 << n) - 1] = Fraction(1)
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [row[n + 1:] for row in rows[:n]]


def text_failures(text: Column) -> dict[str, Column]:
    """A: under 50 words; B: under 65 % of them distinct; C: over 5 % of the characters
    are A-Z; D: holds one of ``#$%&*|``."""
    words = F.array_remove(F.split(text, SPACE, -1), "")
    return {"A": F.size(words) < 50,
            "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
            "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def failure_counts(docs: DataFrame, labels: DataFrame, failures=text_failures) -> DataFrame:
    """part, mask, n, good, toxic: documents per part and set of failed filters.  The
    filters are those of ``failures(text)`` in order, then that of repeated texts."""
    text = F.coalesce("text", F.lit(""))
    found = failures(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(found.values())), F.lit(0))
    rows = materialize(rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("same")), "audit")
    firsts = rows.where("doc_id is not null").groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    repeats = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (rows.join(firsts, ["same", "doc_id"], "left").join(marks, "doc_id", "left")
            .withColumn("mask", F.col("mask") + F.when(repeats, 1 << len(found)).otherwise(0))
            .groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                                         F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def coalitions(counts: DataFrame, n: int) -> DataFrame:
    """Per part ``total`` and the arrays ``removed``, ``good`` and ``toxic``: what every
    coalition of the ``n`` filters removes, by the coalition's bits."""
    tables = [F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0)) for s in range(1 << n)]).alias(name)
              for c, name in (("n", "removed"), ("good", "good"), ("toxic", "toxic"))]
    return counts.groupBy("part").agg(F.sum("n").alias("total"), *tables)


def interactions(table: DataFrame, names: str) -> DataFrame:
    """One row per part, order of the filters and step; ``shapley`` is the sum of the
    filter's removals over all orders, its Shapley value times their number."""
    n, orders = len(names), math.factorial(len(names))
    factors = [[int(x * orders) for x in row] for row in shapley_solution(n)]  # whole numbers: n! clears every denominator
    removed = F.col("removed")
    values = [sum((k * removed[s] for s, k in enumerate(row) if k), F.lit(0).cast("long")) for row in factors]
    rows = table.select("*", F.array(*values).alias("values"), F.explode(F.lit(["".join(p) for p in permutations(names)])).alias("filter_order"))
    rows = rows.select("*", F.explode(F.lit(list(range(1, n + 1)))).alias("step"))

    def bits(letters: Column) -> Column:
        return sum((F.when(letters.contains(name), 1 << i).otherwise(0) for i, name in enumerate(names)), F.lit(0))
    order, step, full = F.col("filter_order"), F.col("step"), (1 << n) - 1
    rows = rows.select("*", bits(order.substr(F.lit(1), step - 1)).alias("before"), bits(order.substr(step, F.lit(1))).alias("own"),
                       (F.instr(F.lit(names), order.substr(step, F.lit(1))) - 1).alias("at"))
    before, own = F.col("before"), F.col("own")
    after, here = before + own, removed[before + own] - removed[before]
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - removed[after]).alias("kept"), here.alias("removed"),
        (removed[own] - here).alias("redundant"), (removed[full] - removed[full - own]).alias("unique_fails"),
        (F.col("good")[after] - F.col("good")[before]).alias("good_lost"), (F.col("toxic")[after] - F.col("toxic")[before]).alias("toxic_lost"),
        F.col("values")[F.col("at")].alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, failures=text_failures, repeated: str = "E") -> DataFrame:
    """All orders of the filters of ``failures`` and of repeated texts, per source."""
    names = "".join(failures(F.lit(""))) + repeated
    if len(set(names)) != len(names):
        raise ValueError(f"filters need names of one letter each, all different: {names}")
    return interactions(coalitions(failure_counts(docs, labels, failures), len(names)), names)
