"""What a SentencePiece model file holds, and how its texts part into words.

No piece of the models used here holds a space mark after another character, so a text
parts before every run of spaces into words that are segmented independently; a run's
marks belong to the word after it, and one mark stands before the text.  The loader
checks that, and that no piece holds a line end, at which words part further.
"""

from __future__ import annotations

import re

MARK = "▁"
_SPACED = re.compile(r" +[^ ]*")


class Pieces:
    """Normal pieces with ids and scores, and the ids of the byte pieces."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        self.unknown = model.unk_id()
        self.bytes = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {names[i]: i for i in normal}
        self.scores = {names[i]: model.get_score(i) for i in normal}
        if len(self.bytes) != 256 or any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError(f"{path}: words of this model do not part at spaces")


def words(text: str) -> list[str]:
    """The words of a text; each stands after one mark, further leading spaces are kept."""
    found = text.split(" ") if text else []
    if "" in found:
        found = [s[1:] for s in _SPACED.findall(" " + text)]
    return found


class Memo(dict):
    """Values by word in two generations: a full one becomes the old one, and what is
    asked for again moves on to the new one.  Long words are not kept."""

    def __init__(self, make, size: int, chars: int = 40) -> None:
        self.make, self.size, self.chars, self.old = make, size, chars, {}

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            value = self.make(word)
        self.put(word, value)
        return value

    def put(self, word: str, value) -> None:
        if len(word) <= self.chars:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[word] = value
