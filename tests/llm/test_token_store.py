import json
import zlib

import numpy as np
import public_tokenizers
import pytest

from kinora.llm import common, token_store
from kinora.session import work_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, " ", "a  b", "Hello world,  don't\n stop\t now", " lead and trail ", "naïve café　über  x\x1cy",
         "word " * 4000, "x" * 30_000, "<|endoftext|> kept as text", "a <|endoftext|> b", "x<|endoftext|><|endoftext|> \n y<|endoftext|", "it's we'll I'd 's x's. don't, a.b, (x). 12. 1,2; ñandú! Straße? 東京. ٣. ½, x²; _.",
         "a line\nanother line, here.\nlast\n", "tab\there", "nbsp\u00a0x y", "ĀžƏ Ǆe", "e\u0301x, y", "a  b \n\n c", "a b", "a b"]


def plain(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_word_cache_gives_the_ids_of_whole_texts():
    encoder = token_store.Encoder(TOKENIZER, 2)
    got = [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode([t or "" for t in TEXTS])]
    assert got == plain(TEXTS)


def test_words_at_random():
    import random
    rng = random.Random(3)
    parts = ["the", "The", "é", "'s", "'", ".", ",", "!", "\n", " ", "  ", "1", "²", "½", "x", "ß", "東", "\t", "\u2003", "\x1c", "_", "😀", "’", "<|endoftext|>", "<|"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(4000)]
    encoder = token_store.Encoder(TOKENIZER, 2)
    got = [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode(texts)]
    assert got == plain(texts)


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_WORDS", 7)
    texts = [" ".join(f"w{(i * j) % 23}" for j in range(30)) for i in range(20)]
    encoder = token_store.Encoder(TOKENIZER, 2)
    assert [np.frombuffer(x, encoder.width).tolist() for x in encoder.encode(texts)] == plain(texts)


def test_files_read_back_in_order(spark):
    rows = [(100 - i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    path = work_dir(spark, "test-tokens")
    manifest = token_store.write_tokens(docs, path, TOKENIZER, shard_bytes=2000)
    got = {r.doc_id: r for r in token_store.read_tokens(spark, path, ids=True).collect()}
    ids = dict(zip([r[0] for r in rows], plain([r[1] for r in rows]), strict=True))
    start = 0
    for key in sorted(ids, key=lambda k: (k is not None, k or 0)):
        want = ids[key]
        assert (got[key].start, got[key].n_tokens, got[key].ids) == (start, len(want), want)
        assert got[key].ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        start += len(want)
    assert manifest["n_tokens"] == start
    assert [x.tolist() for x in token_store.lookup(path, 97)] == [ids[97]]
    assert token_store.lookup(path, 5000) == []


def test_repeated_rows_and_other_dictionary(spark):
    docs = spark.createDataFrame([(1, "same")] * 30 + [(2, "b")], "doc_id long, text string")
    path = work_dir(spark, "test-tokens")
    token_store.write_tokens(docs, path, TOKENIZER)
    rows = sorted(token_store.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [1] * 30 + [2]
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])
    assert len(token_store.lookup(path, 1)) == 30
    with common.open_file(f"{path}/manifest.json") as f:
        shard = json.loads(f.read())["shards"][0]["shard"]
    with pytest.raises(ValueError):
        token_store.Shard(f"{path}/{shard}", b"another", 2)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.token_store(docs, TOKENIZER).collect() == []


def test_dictionary_is_shared_and_shrinks_short_documents(spark):
    docs = spark.createDataFrame([(i, f"the usual words of a short text number {i % 7} again") for i in range(800)],
                                 "doc_id long, text string")
    with_it, without = work_dir(spark, "test-tokens"), work_dir(spark, "test-tokens")
    a = token_store.write_tokens(docs, with_it, TOKENIZER)
    b = token_store.write_tokens(docs, without, TOKENIZER, sample_docs=0)
    size = lambda m: sum(s["bytes"] for s in m["shards"])
    assert size(a) < size(b)
    assert token_store.read_tokens(spark, with_it).count() == token_store.read_tokens(spark, without).count() == 800
