import random
import types
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from kinora.llm import merge_dropout as M
from kinora.llm.pieces import MARK

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "é", "東", " ", "  ", "\n", "the", "ing", "😀", "_", "0", "\t", MARK, "ation.", "s,", "x" * 30, "\x00"]
ROWS = [(i, "".join(random.Random(i).choices(PARTS, k=i % 15)), "clash") for i in range(600)] + [
    (None, "no id", ""), (7, None, ""), (8, "twice the same", ""), (8, "twice the same", ""), (9, "long words of a text " * 4000, ""), (10, "unbroken" * 4000, "")]
SCHEMA = "doc_id long, text string, decoded string"


def ids(codec, i, text):
    return np.frombuffer(codec.encode(i, text), "<u2").tolist()


def test_without_dropout_the_ids_are_the_librarys():
    codec, library = M.Codec(MODEL, 0, 0.0, 4), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for i, text, _ in ROWS:
        if text is not None and MARK not in text:
            assert ids(codec, i, text) == library.encode(text)


def test_dropout_is_lossless_seeded_and_varied(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    a = M.decode(M.encode(docs, MODEL, seed=1), MODEL, column="back").collect()
    assert len(a) == len(ROWS) and all(r.back == r.text for r in a)
    assert a[0].__fields__ == ["doc_id", "text", "decoded", "ids", "back"]
    again = M.encode(docs.repartition(7), MODEL, seed=1).collect()
    key = lambda rows: sorted((str(r.doc_id), r.text or "", r.ids or []) for r in rows)
    assert key(a) == key(again)
    other = M.encode(docs, MODEL, seed=2).collect()
    plain = M.encode(docs, MODEL, dropout=0.0).collect()
    assert key(a) != key(other) and key(a) != key(plain)
    assert [r.ids for r in a if r.text is None] == [None] and [r.ids for r in a if r.text == ""][0] == []


def test_each_skip_follows_the_hash():
    """The agenda against a plain loop over all neighbours."""
    codec = M.Codec(MODEL, 5, 0.3, 4)

    def plain(symbols, own):
        parts, skipped = [[i, s] for i, s in enumerate(symbols)], set()
        while True:
            found = [(codec.rank[a[1] + b[1]], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                     if a[1] + b[1] in codec.rank and (a[0], b[0], a[1], b[1]) not in skipped]
            if not found:
                return [s for _, s in parts]
            rank, i = min(found)
            a, b = parts[i], parts[i + 1]
            if M._mix(own, a[0], rank) < codec.bound:
                skipped.add((a[0], b[0], a[1], b[1]))
            else:
                parts[i:i + 2] = [[a[0], a[1] + b[1]]]
    rng = random.Random(9)
    for _ in range(300):
        word = MARK + "".join(rng.choices("abetionsrhd", k=rng.randint(1, 60)))
        own = rng.getrandbits(60)
        assert codec._merged(list(word), own) == codec._heap_merged(list(word), own) == plain(list(word), own)


def test_many_words_at_once_are_segmented_like_one():
    codec = M.Codec(MODEL, 5, 0.3, 4)
    rng = random.Random(10)
    parts = [rng.choice([" ", ""]) + "".join(rng.choices("abetionsrhdé0東жẞ😀", weights=[6] * 11 + [1] * 6, k=rng.randint(1, 30))) for _ in range(2000)]
    known = 0
    for stream in (0, 3):
        for part, got in zip(parts, codec._many(stream, parts), strict=True):
            assert got is None or got == codec._part(stream, part)
            known += got is not None
    assert known > 1000


def test_every_occurrence_draws_for_itself():
    """Segmentations of one word in one document and across documents, against random keys."""
    codec, rng = M.Codec(MODEL, 6, 0.1), random.Random(12)
    for word in ("the", "internationalisation"):
        got = Counter(codec.encode(i, word) for i in range(4000))
        random_keys = Counter(codec._part(rng.getrandbits(64), " " + word) for _ in range(4000))
        assert len(got) > 2 and all(abs(n - got[k]) < 200 for k, n in random_keys.items())
    repeated = ids(codec, 1, " ".join(["internationalisation"] * 300))
    assert codec.decode(repeated) == " ".join(["internationalisation"] * 300)
    starts = [i for i, x in enumerate(repeated) if codec.text[x].startswith(b" ")] + [len(repeated)]
    assert len({tuple(repeated[a:b]) for a, b in zip(starts, starts[1:], strict=False)}) > 10


def test_what_a_worker_keeps_does_not_matter():
    texts = [(i, t) for i, t, _ in ROWS if t is not None]
    one, few = M.Codec(MODEL, 5, 0.3), M.Codec(MODEL, 5, 0.3, 4)
    every = one.encode_many(*map(list, zip(*texts, strict=True)))
    assert every == [few.encode(i, t) for i, t in texts]
    assert [one.decode(np.frombuffer(e, "<u2").tolist()) for e in every] == [t for _, t in texts]


def test_a_tree_gives_what_each_occurrence_alone_gives(monkeypatch):
    """Nodes for every skip met, or for none, against one codec that never keeps any."""
    rng = random.Random(13)
    vocabulary = ["".join(rng.choices("abetionsrhd東", k=rng.randint(1, 40))) for _ in range(25)] + ["a.b", "line\nend", "mark!!"]
    texts = [" ".join(rng.choices(vocabulary, k=400)) for _ in range(30)]
    every = []
    for few in (1, 1 << 30):
        monkeypatch.setattr(M, "FEW", few)
        codec = M.Codec(MODEL, 5, 0.3)
        every.append([e for i in range(0, 30, 7) for e in codec.encode_many(list(range(i, min(i + 7, 30))), texts[i:i + 7])])
        nodes = codec.memo.at["part"]
        if few == 1:
            skips = codec.memo.skips.data[:codec.memo.skips.n]
            assert nodes.n > 500 and max(bin(x).count("1") for x in skips.tolist()) > 3
            for node in rng.sample(range(nodes.n), 200):  # a node's skips are among its candidates
                assert int(skips[node]).bit_length() <= codec.memo.at["n_codes"].data[node]
        else:
            assert nodes.n == 0
    monkeypatch.setattr(M, "DRAWS", 97)
    assert every[0] == every[1] == [M.Codec(MODEL, 5, 0.3, 4).encode(i, t) for i, t in enumerate(texts)]
    assert [codec.decode(np.frombuffer(e, "<u2").tolist()) for e in every[0]] == texts


def test_pairs_of_a_full_table():
    rng = np.random.default_rng(3)
    ranks = {int(a) << 32 | int(b): i for i, (a, b) in enumerate(zip(rng.integers(0, 40, 900), rng.integers(0, 40, 900), strict=True))}
    table = M.Pairs(ranks)
    left, right = np.meshgrid(np.arange(-1, 45, dtype=np.int32), np.arange(-1, 45, dtype=np.int32))
    want = [[ranks.get((int(a) << 32) + int(b), M._NONE) for a, b in zip(x, y, strict=True)] for x, y in zip(left, right, strict=True)]
    assert table.get(left, right).tolist() == want


def test_lists_are_decoded_like_one():
    codec = M.Codec(MODEL, 1, 0.5)
    some = [None if t is None else np.frombuffer(codec.encode(i, t), "<u2").tolist() for i, t, _ in ROWS]
    lists = pa.array([*some, []], pa.list_(pa.int32()))
    want = [None if x is None else codec.decode(x) for x in lists.to_pylist()]
    assert codec.decode_many(lists).to_pylist() == want
    assert codec.decode_many(lists.slice(3, 50)).to_pylist() == want[3:53]
    assert codec.decode_many(lists[:0]).to_pylist() == []
    assert codec.decode_many(pa.array([None, []], pa.list_(pa.int32()))).to_pylist() == [None, ""]
    odd = [[codec.pieces.bytes[0xE6]], [codec.ids["a"]], [codec.ids[MARK], codec.pieces.bytes[0xFF], codec.ids["a"]]]  # no texts
    assert codec.decode_many(pa.array(odd, pa.list_(pa.int32()))).to_pylist() == [codec.decode(x) for x in odd]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert M.decode(M.encode(docs, MODEL), MODEL, column="back").collect() == []


def task_of(monkeypatch, operator, *args):
    """What a task of an operator runs over its Arrow batches."""
    monkeypatch.setattr(M.common, "small_batches", lambda spark: None)
    monkeypatch.setattr(M.common, "extended", lambda df, made, **added: made(str))
    return operator(types.SimpleNamespace(sparkSession=None), *args)


def test_a_worker_that_waits_keeps_no_words(monkeypatch):
    texts = [" ".join(f"word{i}x{j}" for j in range(300)) for i in range(4)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(4)), "text": texts})
    run, codec = task_of(monkeypatch, M.encode, MODEL, 3, 0.1), M.codec_of(MODEL, 3, 0.1)
    out = next(task := run(iter([batch])))
    assert len(codec.memo) >= 1200 and out.num_rows == 4  # kept as long as the task runs
    assert list(task) == [] and M.codec_of(MODEL, 3, 0.1) is codec
    assert not len(codec.memo) and not codec.memo.parts and not codec.memo.codes.n
    assert next(run(iter([batch]))).equals(out)


def test_words_and_ids_at_a_time_are_bounded(monkeypatch):
    codec = M.Codec(MODEL, 3, 0.1)
    most = 0
    for i in range(12):
        codec.encode_many([i], [" ".join(f"{i}.{j}" for j in range(40_000))])
        most = max(most, len(codec.memo))
    assert most < 250_000
    ids = [codec.encode_many([i], ["some words " * 3_000]) for i in range(40)]
    lists = pa.array([np.frombuffer(x[0], "<u2").astype(np.int32) for x in ids])
    out = list(task_of(monkeypatch, M.decode, MODEL)(iter([pa.RecordBatch.from_pydict({"ids": lists})])))
    assert max(len(b.column(0).flatten()) for b in out) <= 1 << 16
    assert [x for b in out for x in b.column(1).to_pylist()] == ["some words " * 3_000] * 40
