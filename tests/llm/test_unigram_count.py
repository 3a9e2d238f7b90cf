import random

import public_tokenizers

from kinora.llm import unigram_count as U
from kinora.llm.pieces import MARK

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "é", "東", " ", "  ", "\n", "the", "ing", "😀", "_", "0", "\t", MARK, "Ж", "x" * 30]


def reference():
    """The same vocabulary in a library's unigram tokenizer."""
    import sentencepiece
    from tokenizers import Tokenizer, models
    m = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    vocabulary = [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())]
    t = Tokenizer(models.Unigram(vocabulary, unk_id=m.unk_id(), byte_fallback=True))
    return lambda text: len(t.encode(MARK + text.replace(" ", MARK)).ids) if text else 0


def test_counts_equal_the_tokenizers(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 15))) for _ in range(1500)] + ["words of a text " * 5000, "unbroken" * 9000, " ", "\n\n"]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "no id", ""), (7, None, ""), (8, "twice", ""), (8, "twice", "")]
    got = U.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), MODEL).collect()
    count = reference()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(((i, count(t or "")) for i, t, _ in rows), key=str)


def test_ties_keep_the_longest_last_piece(tmp_path):
    """Pieces of equal total score but different numbers, against every segmentation."""
    import ahocorasick
    scores = {"a": -1.0, "b": -1.0, "ab": -2.0, "aba": -3.0, "ba": -2.0, "bab": -3.0}
    c = U.Counter.__new__(U.Counter)
    c.automaton, c.single, c.unknown = ahocorasick.Automaton(), {"a", "b"}, -13.0
    for p, s in scores.items():
        c.automaton.add_word(p, (len(p), s))
    c.automaton.make_automaton()

    def plain(text):
        best = [(0.0, 0)]
        for end in range(1, len(text) + 1):
            value = None
            for start in range(end):
                s = scores.get(text[start:end])
                if s is not None and (value is None or best[start][0] + s > value[0]):
                    value = (best[start][0] + s, best[start][1] + 1)
            best.append(value)
        return best[-1][1]
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choices("ab", k=rng.randint(1, 12)))
        assert c.best(text) == plain(text)


def test_empty(spark):
    assert U.token_counts(spark.createDataFrame([], "doc_id long, text string"), MODEL).collect() == []
