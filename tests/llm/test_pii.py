import hashlib
import random
import re

from kinora.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def plain(text):
    def ok(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


TEXTS = ["", None, "😀é a@b.c a@b.c_d@e.f.g x@y @z.w a..b@c-d.e.f", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.0255.256 1.2.3.255.9",
         "4111 1111 1111 1111 4111-1111-1111-1112 4 1 1 11111111111111 41111111111111111111", "+1 (555) 123-4567+49 30 1234567- +1 2",
         "+" * 3000 + "1" * 5000, "a" * 60_000, "1 " * 20_000, "x.y" * 5000 + "@" + "a.b" * 5000, "1.1.1.1 " * 3000,
         "call 555-123-4567 token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" 4532015112830367"]


def check(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = pii.find(docs, pii.fit(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id] or "")[:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k + ":") for w in want) for k in PATTERNS]
        every = r.spans.split(",") if r.spans else []
        assert [s for s in every if s.split(":")[0] in PATTERNS] == want
        assert len(every) == len(want) + r.n_added


def test_base_spans_match_plain_regex(spark):
    check(spark, TEXTS)


def test_random_texts(spark):
    rng = random.Random(7)
    parts = ["a", "B9", "@", ".", "..", "-", "_", "+", "1", "255", "4111111111111111", " ", "  ", "(", ")", "é", "\n", "😀", "%", ".com", "12-34"]
    check(spark, ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(400)])


def test_em_finds_reliable_labelers():
    rng = random.Random(1)
    counts = {}
    for _ in range(5000):
        truth = rng.random() < 0.3
        votes = tuple((1 if (rng.random() < p) == truth else -1) if rng.random() < 0.9 else 0 for p in (0.95, 0.85, 0.65))
        counts[votes] = counts.get(votes, 0) + 1
    prior, tables, post = pii._reliability(counts, 50)
    assert abs(prior - 0.3) < 0.05 and tables[0][1][0] > tables[2][1][0]
    assert post[(1, 1, 1)] > 0.95 > 0.05 > post[(-1, -1, -1)]


def test_added_spans_and_redaction(spark):
    secret = "24be64439e3e49cf46b2d7c90f3602a3d0b907f"
    texts = [f'it said token = "{secret}{i % 10}" there' for i in range(60)] + [f"plain word{i} without anything of note" for i in range(60)]
    texts += [f"a long {'identifier_without_digits' if i % 2 else 'averyveryverylongwordindeed'} of code" for i in range(40)] + [None, "mail me@x.org é 4111111111111111!"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, `n.chars` int")
    model = pii.fit(docs)
    found = {r.doc_id: r for r in pii.find(docs, model).collect()}
    assert all(found[i].n_added == 1 and found[i].spans == f"secret:{14 + 3}:{14 + 3 + 40}" for i in range(60))
    assert all(found[i].n_added == 0 for i in range(60, 160))
    out = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert out[0] == 'it said token = "[SECRET]" there' and out[60] == texts[60] and out[160] is None
    assert out[161] == "mail [EMAIL] é [CARD]!"
    assert pii.redact(docs, model).columns == docs.columns


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(docs, pii.fit(docs)).collect() == [] and pii.redact(docs, pii.fit(docs)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = pii.find(docs, pii.fit(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
