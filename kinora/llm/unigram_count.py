"""Token counts of a unigram tokenizer without building its tokens.

Per word an Aho-Corasick automaton enumerates every vocabulary match by its end, and
dynamic programming carries the best score and its number of pieces for each prefix; no
segmentation is kept.  Ties follow the tokenizer: candidates for a prefix come in order
of their start and only a better score replaces one, so the longest last piece stays; a
character that is no piece itself may be unknown, at the lowest score less 10, and counts
as its UTF-8 bytes.  Scores of the vocabulary used here are whole numbers, so sums are
exact in double precision and words add up to texts.

Cases: a null or empty text has no tokens; rows that repeat and null ids are counted row
by row; texts of any length and words of any length are counted whole; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from kinora.llm import common
from kinora.llm.pieces import MARK, Memo, Pieces, words

UNKNOWN_PENALTY = 10.0
#: Words that each of a worker's two cache generations holds.
MEMO_WORDS = 600_000


class Counter:
    def __init__(self, path: str) -> None:
        pieces = Pieces(path)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces.scores if len(p) == 1}
        self.unknown = min(pieces.scores.values()) - UNKNOWN_PENALTY
        self.memo = Memo(self._word, MEMO_WORDS)

    def best(self, text: str) -> int:
        """Pieces of the best segmentation of a text in the tokenizer's own characters."""
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        done = 0  # prefixes up to here have their final score

        def unknown(i: int, s: float | None, c: int) -> None:
            """Finish the prefix of i + 1 characters, whose best match so far is (s, c)."""
            ch = text[i]
            if ch not in self.single and (s is None or score[i] + self.unknown > s):
                s, c = score[i] + self.unknown, count[i] + len(ch.encode())
            score[i + 1], count[i + 1] = s, c

        at, s, c = -1, None, 0
        for end, (length, value) in self.automaton.iter(text):
            if end != at:
                if at >= 0:
                    unknown(at, s, c)
                    done = at + 1
                while done < end:
                    unknown(done, None, 0)
                    done += 1
                at, s = end, None
            start = end + 1 - length
            if s is None or score[start] + value > s:  # longest first, so starts ascend
                s, c = score[start] + value, count[start] + 1
        if at >= 0:
            unknown(at, s, c)
            done = at + 1
        while done < n:
            unknown(done, None, 0)
            done += 1
        return count[n]

    def _word(self, word: str) -> int:
        """Pieces of a word after its mark, or, if a space ends it, of one without a mark;
        a line end is one byte and in no piece, so words part there."""
        if "\n" in word:
            first, *lines = word.split("\n")
            return self.memo[first] + sum(1 + (self.memo[x + " "] if x else 0) for x in lines)
        if word[-1:] == " " and word.strip(" "):
            return self.best(word[:-1])
        return self.best(MARK + word.replace(" ", MARK))

    def count(self, text: str) -> int:
        return sum(map(self.memo.__getitem__, words(text.replace(MARK, " ") if MARK in text else text)))


@functools.lru_cache(maxsize=2)
def counter_of(path: str) -> Counter:
    """One counter per worker process, so that its memo outlives a task."""
    return Counter(path)


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and n_tokens of each row's whole text."""
    common.small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.claim("unigram_count", counter_of.cache_clear)
        counter = counter_of(model)
        for batch in batches:
            counts = [counter.count(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")
