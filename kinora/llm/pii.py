"""Personal data by weak supervision, in DataFrame functions only.

Base spans: four patterns with a check of each match (parts, Luhn, digit counts).
Further spans: wider patterns propose candidates; a regex, a gazetteer and a context
labeler vote on each (+1 personal, -1 not, 0 abstains); expectation-maximisation over
the counts of vote patterns estimates each labeler's reliability, and its posteriors
train a naive Bayes span classifier over shape and neighbourhood, which decides.
Base spans always stay; a candidate that overlaps one is dropped.

Positions are code points.  A kind's matches come from one ``regexp_extract_all`` and
the gaps between them from one ``split``; running sums by doubling give the starts, so
no row is exploded and nothing is shuffled but the counts of vote patterns, whose
number is bounded by the labelers' and features' few values.  The maximisation itself
is arithmetic over the 27 vote patterns at most of a family.

Patterns are written with possessive parts and anchored at the start of a run (or at
the end of the last match), which leaves their matches as they are and the time linear.

Cases: a null text is an empty one (no spans); repeated rows and null ids are treated
row by row; an empty table gives no rows and the default model; further columns are
kept by ``redact`` and ignored by ``find``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinora.llm.common import quoted
from kinora.session import materialize

# Base patterns of the contract, without their needless backtracking.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of 16 to 19 digits passes the Luhn check."""
    def value(i: Column) -> Column:  # i counts from the right, from 1
        d = F.ascii(F.substring(digits, F.length(digits) - i + 1, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i))
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(F.lit(False))


#: kind: (pattern, what a text must hold to be searched, check of a match)
BASE = {
    "email": (EMAIL, "@", lambda m: F.lit(True)),
    "ip": (IP, "[0-9]", lambda m: m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
    "card": (CARD, "[0-9]", lambda m: _luhn(_digits(m))),
    "phone": (PHONE, r"\+", lambda m: F.length(_digits(m)).between(8, 15)),
}

# Candidate families: pattern, and for each labeler what speaks for and against.
# Cue words are in the corpus languages; issuer and area prefixes are public ranges.
CUES = r"(?i)(?:tel|phone|call|fax|mobile|whatsapp|card|account|iban|ssn|passport|carte|karte|konto|tarjeta|cuenta|teléfono|téléphone|telefon)[^\n]{0,12}$"
FAMILIES = {
    "number": {
        "pattern": r"(?<![A-Za-z0-9.+-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}+(?![A-Za-z0-9])",
        "needs": "[0-9]{2}",
        "regex": (r"^(?:\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{4}(?:[\x20-]?[0-9]{4}){3})$",
                  r"^(?:(?:19|20)[0-9]{2}[.-][0-9]{1,2}[.-][0-9]{1,2}|[0-9]{1,2}\.[0-9]{1,2}\.(?:19|20)[0-9]{2}|[0-9]+\.[0-9]+)$"),
        "gazetteer": (r"^\(?(?:4[0-9]{3}|5[1-5][0-9]{2}|3[47][0-9]{2}|6011|212|213|312|415|617|718|800|888)", r"^(?:0000|1234567|9999999)"),
        "context": (CUES, r"(?i)(?:[$€£]|page|version|isbn|total|price|no\.|#)\s?$"),
    },
    "secret": {
        "pattern": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9_-]{20,64}+(?![A-Za-z0-9+/_=-])",
        "needs": r"[A-Za-z0-9_-]{20}",
        "regex": (r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|AKIA[0-9A-Z]{16}|gh[pousr]_\w{36})$", r"^(?:[A-Za-z]+|[0-9]+|.*(?:__|--).*)$"),
        "gazetteer": (r"^(?=.*[0-9])(?=.*[A-Za-z])(?:AKIA|ghp_|sk_|xox|[0-9a-fA-F]+$)", r"(?i)(?:license|version|example|lorem|index|class)"),
        "context": (r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|key|credential|auth)\W{0,6}$", r"(?i)(?:https?://\S*|sha-?[0-9]*|md5|commit)\W{0,3}$"),
    },
}
LABELERS = ("regex", "gazetteer", "context")
KINDS = [*BASE, *FAMILIES]
SHAPES = 64
BEFORE = 40


def _running_sum(x: Column) -> Column:
    """Sums up to and with each element of an int array, by doubling."""
    def step(acc: Column, s: Column) -> Column:
        rest = F.size(acc) - s
        return F.when(rest > 0, F.concat(F.slice(acc, 1, s), F.zip_with(
            F.slice(acc, s + 1, rest), F.slice(acc, 1, rest), lambda a, b: a + b))).otherwise(acc)
    return F.aggregate(F.array(*[F.lit(1 << i) for i in range(28)]), x, step)


def _hits_and_gaps(source: Column, kind: str, pattern: str, needs: str) -> list[Column]:
    gap = F.transform(F.split(source, pattern, -1), lambda p: F.struct(
        F.length(p).alias("n"), F.right(p, F.lit(BEFORE)).alias("before"), F.left(p, F.lit(1)).alias("after")))
    return [F.when(source.rlike(needs), F.regexp_extract_all(source, F.lit(pattern), F.lit(0)))
            .otherwise(F.array().cast("array<string>")).alias(f"_hit_{kind}"),
            F.when(source.rlike(needs), gap)
            .otherwise(F.array().cast("array<struct<n:int,before:string,after:string>>")).alias(f"_gap_{kind}")]


def _ends(kind: str) -> Column:
    gap = F.col(f"_gap_{kind}")
    steps = F.transform(f"_hit_{kind}", lambda h, i: F.length(h) + F.get(gap, i)["n"])
    return F.when(F.size(f"_hit_{kind}") > 0, _running_sum(steps)).otherwise(F.array().cast("array<int>")).alias(f"_end_{kind}")


def _spans(kind: str) -> Column:
    gap, end = F.col(f"_gap_{kind}"), F.col(f"_end_{kind}")
    return F.transform(f"_hit_{kind}", lambda h, i: F.struct(
        h.alias("hit"), (F.get(end, i) - F.length(h)).alias("start"), F.get(end, i).alias("end"),
        F.get(gap, i)["before"].alias("before"), F.get(gap, i + 1)["after"].alias("after"))).alias(kind)


def _matches(rows: DataFrame, text: str, found: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds for each kind an array of (hit, start, end, before, after) in order."""
    keep = rows.columns
    rows = rows.select(*keep, *[c for k, (pattern, needs) in found.items() for c in _hits_and_gaps(F.col(text), k, pattern, needs)])
    rows = rows.select(*rows.columns, *[_ends(k) for k in found])
    return rows.select(*keep, *[_spans(k) for k in found])


def _vote(x: Column, pair: tuple[str, str]) -> Column:
    return F.when(x.rlike(pair[0]), 1).when(x.rlike(pair[1]), -1).otherwise(0)


def _votes(family: str, c: Column) -> list[Column]:
    f = FAMILIES[family]
    return [_vote(c["hit"], f["regex"]).alias("regex"), _vote(c["hit"], f["gazetteer"]).alias("gazetteer"),
            _vote(c["before"], f["context"]).alias("context")]


def _features(c: Column) -> list[Column]:
    """Features of few values each: hashed shape, digit count, length, neighbours."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(c["hit"], "[0-9]+", "9"), "[a-z]+", "a"), "[A-Z]+", "A")
    near = lambda x: F.when(F.length(x) == 0, "^").when(x.rlike(r"^\s$"), " ").when(x.rlike(r"^\w$"), "w").otherwise("p")
    return [F.concat(F.lit("shape:"), F.pmod(F.hash(shape), F.lit(SHAPES)).cast("string")),
            F.concat(F.lit("digits:"), F.least(F.length(_digits(c["hit"])), F.lit(24)).cast("string")),
            F.concat(F.lit("length:"), F.least((F.length(c["hit"]) / 4).cast("int"), F.lit(16)).cast("string")),
            F.concat(F.lit("last:"), near(F.right(c["before"], F.lit(1)))), F.concat(F.lit("next:"), near(c["after"]))]


def _checked(kind: str) -> Column:
    ok = BASE[kind][2]
    return F.filter(kind, lambda s: ok(s["hit"])).alias(kind)


def _clear(family: str, base: list[str]) -> Column:
    """Candidates of a family that overlap no base span."""
    spans = F.concat(*[F.col(k) for k in base])
    return F.filter(family, lambda c: ~F.exists(spans, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns of KINDS: checked base spans and, per family, candidates."""
    clean = docs.withColumn("_text", F.coalesce(text, F.lit("")))
    found = {k: (p, needs) for k, (p, needs, _) in BASE.items()} | {k: (f["pattern"], f["needs"]) for k, f in FAMILIES.items()}
    rows = _matches(clean, "_text", found).drop("_text")
    keep = [c for c in rows.columns if c not in KINDS]
    rows = rows.select(*keep, *FAMILIES, *[_checked(k) for k in BASE])
    return rows.select(*keep, *BASE, *[_clear(f, list(BASE)).alias(f) for f in FAMILIES])


class Model:
    """Labeler reliabilities P(vote | class) and naive Bayes weights of each family."""

    def __init__(self, reliability: dict, weights: dict) -> None:
        self.reliability, self.weights = reliability, weights

    def log_odds(self, family: str, features: Column) -> Column:
        weights = self.weights.get(family)
        if not weights:
            return F.lit(-1e9)
        table = F.create_map(*[F.lit(x) for k, w in sorted(weights.items()) for x in (k, w)])
        return F.aggregate(features, F.lit(float(weights[""])), lambda acc, f: acc + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))


def _reliability(counts: dict[tuple[int, ...], int], rounds: int) -> tuple[float, list[dict], dict]:
    """Expectation-maximisation over the counts of vote patterns (27 at most): the share
    of personal spans, P(vote | class) of each labeler, and P(personal | votes)."""
    prior, tables = 0.5, [{1: (.4, .1), 0: (.5, .5), -1: (.1, .4)} for _ in LABELERS]  # right four times in five
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes in counts:
            yes, no = prior, 1 - prior
            for table, v in zip(tables, votes, strict=True):
                yes, no = yes * table[v][0], no * table[v][1]
            post[votes] = yes / (yes + no)
        yes = sum(n * post[v] for v, n in counts.items())
        no = sum(counts.values()) - yes
        prior = (yes + 1) / (yes + no + 2)
        for i in range(len(LABELERS)):
            for vote in (1, 0, -1):
                own = [(n, post[v]) for v, n in counts.items() if v[i] == vote]
                # Pseudo-counts that a labeler is right keep the classes from changing places.
                tables[i][vote] = ((sum(n * p for n, p in own) + 1 + 3 * (vote == 1)) / (yes + 6),
                                   (sum(n * (1 - p) for n, p in own) + 1 + 3 * (vote == -1)) / (no + 6))
    return prior, tables, post


def fit(docs: DataFrame, text: str = "text", rounds: int = 25) -> Model:
    """Labeler reliabilities by expectation-maximisation, then the span classifier.

    All documents are searched; what is kept is one count per combination of votes and
    feature values, a bounded number."""
    rows = spans(docs.select(text), text)
    rows = rows.select(F.explode(F.concat(*[_cells(f) for f in FAMILIES])).alias("c")).select("c.*")
    cells = materialize(rows.groupBy("family", "votes", "features").count(), "pii-votes")
    counts: dict[str, dict] = {}
    for r in cells.groupBy("family", "votes").agg(F.sum("count").alias("n")).collect():
        counts.setdefault(r.family, {})[tuple(r.votes)] = r.n
    if not counts:
        return Model({}, {})
    found = {f: _reliability(c, rounds) for f, c in counts.items()}
    key = lambda f, v: f + ":" + ",".join(map(str, v))
    table = F.create_map(*[F.lit(x) for f, (_, _, post) in sorted(found.items()) for v, p in sorted(post.items()) for x in (key(f, v), p)])
    post = F.element_at(table, F.concat_ws(":", "family", F.concat_ws(",", F.col("votes").cast("array<string>"))))
    names = F.transform(F.array(*map(F.lit, LABELERS)), lambda n, i: F.concat_ws(":", n, F.get("votes", i).cast("string")))
    sums = (cells.withColumn("yes", post * F.col("count")).withColumn("no", (1 - post) * F.col("count"))
            .select("family", F.explode(F.concat("features", F.array(F.lit("")), names)).alias("feature"), "yes", "no")
            .groupBy("family", "feature").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect())
    total = {r.family: (r.yes, r.no) for r in sums if r.feature == ""}
    weights: dict[str, dict[str, float]] = {}
    for r in sums:
        yes, no = total[r.family]
        weights.setdefault(r.family, {})[r.feature] = (
            math.log((yes + 1) / (no + 1)) if r.feature == "" else math.log((r.yes + .5) / (yes + 8)) - math.log((r.no + .5) / (no + 8)))
    return Model({f: x[:2] for f, x in found.items()}, weights)


def _cells(family: str) -> Column:
    return F.transform(family, lambda c: F.struct(F.lit(family).alias("family"), F.array(*_votes(family, c)).alias("votes"),
                                                  F.array(*_features(c)).alias("features")))


def _sure(model: Model, family: str, least: float, c: Column) -> Column:
    votes = [F.concat(F.lit(f"{n}:"), v.cast("string")) for n, v in zip(LABELERS, _votes(family, c), strict=True)]
    return model.log_odds(family, F.array(*_features(c), *votes)) >= math.log(least / (1 - least))


def _accepted(model: Model, family: str, least: float) -> Column:
    return F.filter(family, lambda c: _sure(model, family, least, c)).alias(family)


def _joined(kinds) -> Column:
    def of(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(F.concat(*[of(k) for k in kinds]), ",")


def find(docs: DataFrame, model: Model, least: float = 0.9) -> DataFrame:
    """Per row: doc_id, counts and digest of the base spans, all spans, and how many were added."""
    rows = spans(docs.select("doc_id", "text"))
    rows = rows.select("doc_id", *BASE, *[_accepted(model, f, least) for f in FAMILIES])
    added = sum((F.size(f) for f in FAMILIES), F.lit(0)).cast("long")
    return rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                       F.sha2(_joined(BASE), 256).alias("base_sha256"), _joined(KINDS).alias("spans"), added.alias("n_added"))


def redact(docs: DataFrame, model: Model, least: float = 0.9, text: str = "text") -> DataFrame:
    """Replaces the spans in ``text`` by ``[KIND]``, kind after kind, each searched in
    what the kinds before it left; other columns stay and a null text stays null."""
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), F.coalesce(quoted(text), F.lit("")).alias("_source"))
    for kind in KINDS:
        family = kind in FAMILIES
        if family and not model.weights.get(kind):
            continue
        pattern, needs = (FAMILIES[kind]["pattern"], FAMILIES[kind]["needs"]) if family else BASE[kind][:2]
        rows = _matches(rows, "_source", {"_found": (pattern, needs)})
        rows = rows.withColumn("_found", _decided(model, kind, least)).withColumn(
            "_gaps", F.when(F.exists("_found", lambda s: s["yes"]), F.split("_source", pattern, -1)))
        rows = rows.select("_row", F.coalesce(_replaced(kind), F.col("_source")).alias("_source"))
    own = lambda c: F.col("_row")[c]
    return rows.select(*[F.when(own(c).isNotNull(), F.col("_source")).alias(c) if c == text else own(c).alias(c) for c in docs.columns])


def _decided(model: Model, kind: str, least: float) -> Column:
    def yes(c: Column) -> Column:
        return _sure(model, kind, least, c) if kind in FAMILIES else BASE[kind][2](c["hit"])
    return F.transform("_found", lambda c: F.struct(c["hit"].alias("hit"), yes(c).alias("yes")))


def _replaced(kind: str) -> Column:
    found = F.col("_found")
    own = lambda s: F.coalesce(F.when(s["yes"], F.lit(f"[{kind.upper()}]")).otherwise(s["hit"]), F.lit(""))
    return F.array_join(F.transform("_gaps", lambda g, i: F.concat(g, own(F.get(found, i)))), "")
