"""SentencePiece encoding of merge type with seeded merge-dropout, and its decoding.

Candidate merges of neighbouring symbols stand in an agenda, best score and then
leftmost first.  Each candidate taken from it is skipped with probability ``dropout`` by
a keyed hash of (seed, doc_id, occurrence, place, piece), where a word's occurrence is its
number in the document, so the same seed gives the same ids anywhere, another seed other
segmentations, and every occurrence of a word its own draws.  A task keeps of each word
that it has met twice the ids and the candidates taken when none is skipped: the root of a
tree whose further nodes have those of a skip more.  An occurrence goes down by its own draws
to the node that skips what it skips; where the tree ends it is segmented afresh, many at once.

What is left of a word is encoded as its pieces, and as byte pieces where a character
has none, so decoding gives back the text whatever was skipped.  A literal space mark
(U+2581) in a text is written as bytes, so that it is not taken for a space.

Cases: a null text has null ids, an empty one none; a null doc_id draws its streams like
an id of its own; rows that repeat an id are encoded alike; any length is encoded whole;
an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinora.llm import common
from kinora.llm.pieces import MARK, Pieces, words

#: Words that a task keeps; with more it forgets all before the next run of texts.
MEMO_WORDS = 200_000
#: Words of more symbols keep their candidates in a heap, shorter ones in a list.
SHORT = 32
#: Candidates that a task keeps, of all its words' trees.
MEMO_CODES = 1_000_000
#: Words that are segmented at the same time, and occurrences whose draws are.
ROWS, DRAWS = 2048, 1 << 16
#: Ids that are decoded at the same time; a longer document stands alone.
DECODED = 1 << 16
#: Fewer new nodes than this of one depth are not worth making.
FEW = 48
#: A node's skips are the bits of one number, so those after that many candidates have no node.
_BITS = 64
# Of a place in the trees without a node: not met yet, met once, not to have one.
_NEW, _MET, _ALONE = -1, -2, -3
_NONE = (1 << 31) - 1
# Symbols from here on are characters without a piece.
_BYTES = 1 << 20
# A letter with marks after it parts there if no piece joins the two.
_MARKED = re.compile(r"(.*[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])([!-/:-@\[-^`{-~]+)", re.DOTALL)
_JOINED = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][!-/:-@\[-^`{-~]")
_LITERAL = "" + MARK
_MASK = (1 << 64) - 1


def _mix(key: int, place: int = 0, rank: int = 0) -> int:
    """53 bits of a hash of a key, a place and a piece."""
    x = (key + (place << 16 | rank) * 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    return (x ^ (x >> 29)) >> 11


def _skipped(own: np.ndarray, code: np.ndarray, bound: int) -> np.ndarray:
    """Whether ``_mix`` of each key and (place << 16 | rank) is below the bound."""
    x = own + code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(11)) < np.uint64(bound)


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind) -> None:
        self.data, self.n = np.empty(1024, kind), 0

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.empty(self.n + len(more), self.data.dtype)])
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)


class Pairs:
    """Ranks of pairs of ids, in a table by hash; a pair stands in the first free slot from its own on."""

    def __init__(self, ranks: dict[int, int]) -> None:
        keys = np.array(sorted(ranks), np.int64)
        values = np.array([ranks[k] for k in keys.tolist()], np.int32)
        bits = max(4, len(keys).bit_length() + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.ranks = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32)
        at = self._slot(keys)
        while len(keys):
            slot, first = np.unique(at, return_index=True)
            first = first[self.keys[slot] == -1]
            self.keys[at[first]], self.ranks[at[first]] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values, at = keys[left], values[left], (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks, ``_NONE`` where there is no such pair."""
        keys = ((left.astype(np.int64) << 32) + right).ravel()
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.ranks[at], _NONE).astype(np.int32)
        go = np.flatnonzero((there != keys) & (there != -1))
        at = at[go]
        while len(go):
            at = at + 1 & self.mask
            there = self.keys[at]
            same = there == keys[go]
            out[go[same]] = self.ranks[at[same]]
            on = ~same & (there != -1)
            go, at = go[on], at[on]
        return out.reshape(left.shape)


def _spread(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places at, at + 1, ... of each of several ranges, one after another."""
    return np.arange(size.sum()) + np.repeat(at - np.cumsum(size) + size, size)


class Words(dict):
    """Numbers of words, and their parts' texts and trees.  A word that parts further has
    a negative number, of its row in ``several``.

    A node has the ids and candidates of a part under some skips; a slot stands for a
    part's root, or for the node that skips one of a node's candidates more."""

    def __init__(self, split) -> None:
        self.split, self.parts, self.several = split, [], []
        self.flat, self.n_flat = Grown(np.int64), Grown(np.int64)  # of several
        self.ids, self.codes = Grown(np.uint16), Grown(np.uint32)
        self.size, self.root = Grown(np.int64), Grown(np.int64)  # of parts: characters, slot
        self.node, self.owner = Grown(np.int32), Grown(np.int32)  # of slots: node, and node it is of or -1 - part
        self.at = {k: Grown(np.int64) for k in ("ids", "n_ids", "codes", "n_codes", "slots", "begin", "part")}  # of nodes
        self.skips = Grown(np.uint64)
        self.chars = 0

    def __missing__(self, word: str) -> int:
        found = self.split(word)
        if isinstance(found, str):
            number = len(self.parts)
            self.parts.append(found)
            self.chars += len(found)
        else:
            items: list[int] = []
            for w in found:
                i = self[w]
                items += [i] if i >= 0 else self.several[-1 - i]
            self.several.append(items)
            number = -len(self.several)
        self[word] = number
        return number

    def parted(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers with those of the words that words part into, and how many each has become."""
        more = self.several[self.n_flat.n:]
        self.flat.extend(np.fromiter(itertools.chain.from_iterable(more), np.int64))
        self.n_flat.extend(np.fromiter(map(len, more), np.int64, len(more)))
        n = np.ones(len(numbers), np.int64)
        wide = np.flatnonzero(numbers < 0)
        size = self.n_flat.data[:self.n_flat.n]
        which = -1 - numbers[wide]
        n[wide] = size[which]
        out = np.repeat(numbers, n)
        first = (np.cumsum(n) - n)[wide]
        out[_spread(first, n[wide])] = self.flat.data[_spread((np.cumsum(size) - size)[which], n[wide])]
        return out, n

    def plant(self) -> None:
        """A slot for each part that has none."""
        parts = np.arange(self.root.n, len(self.parts))
        self.root.extend(self.node.n + parts - parts[:1].sum())
        self.size.extend(np.fromiter(map(len, self.parts[len(self.parts) - len(parts):]), np.int64, len(parts)))
        self.node.extend(np.full(len(parts), _NEW, np.int32))
        self.owner.extend((-1 - parts).astype(np.int32))

    def meaning(self, slots: np.ndarray):
        """(part, skips, first candidate not drawn for yet) of each slot's node."""
        owner = self.owner.data[slots].astype(np.int64)
        root, up = owner < 0, np.maximum(owner, 0)
        step = np.where(root, 0, slots - self.at["slots"].data[up])
        part = np.where(root, -1 - owner, self.at["part"].data[up])
        skips = np.where(root, np.uint64(0), self.skips.data[up] | np.uint64(1) << step.astype(np.uint64))
        return part, skips, np.where(root, 0, step + 1)

    def add(self, slots: np.ndarray, ids: np.ndarray, n_ids: np.ndarray, codes: np.ndarray, n_codes: np.ndarray) -> None:
        """The nodes of slots."""
        part, skips, begin = self.meaning(slots)
        first = self.at["ids"].n
        self.node.data[slots] = np.arange(first, first + len(slots))
        for name, flat, n in (("ids", ids, n_ids), ("codes", codes, n_codes)):
            store = getattr(self, name)
            self.at[name].extend(store.n + np.cumsum(n) - n)
            self.at["n_" + name].extend(n)
            store.extend(flat)
        self.at["slots"].extend(self.node.n + np.cumsum(n_codes) - n_codes)
        self.at["begin"].extend(begin)
        self.at["part"].extend(part)
        self.skips.extend(skips)
        self.node.extend(np.where(_spread(np.zeros(len(n_codes), np.int64), n_codes) < _BITS, _NEW, _ALONE).astype(np.int32))
        self.owner.extend(np.repeat(np.arange(first, first + len(slots), dtype=np.int32), n_codes))


class Decoder:
    def __init__(self, path: str) -> None:
        self.pieces = Pieces(path)
        self.ids = self.pieces.ids
        self.text = {i: p.replace(MARK, " ").encode() for p, i in self.ids.items()} | {i: bytes([b]) for b, i in self.pieces.bytes.items()}

    def decode(self, ids) -> str:
        """The text of a sequence of ids, without the mark before it."""
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")[1:]

    @functools.cached_property
    def _bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all ids, where an id's begin, their number); an unknown id has -1."""
        top = max(self.text) + 1
        size = np.full(top, -1, np.int64)
        for i, t in self.text.items():
            size[i] = len(t)
        n = np.maximum(size, 0)
        return np.frombuffer(b"".join(self.text[i] for i in sorted(self.text)), np.uint8), np.cumsum(n) - n, size

    def decode_many(self, lists: pa.Array) -> pa.Array:
        """What ``decode`` gives for each list of ids, null for a null one."""
        data, at, size = self._bytes
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        each = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        plain = not len(ids) or (ids.dtype.kind in "iu" and int(ids.min()) >= 0 and int(ids.max()) < len(size) and int(size[ids].min()) >= 0)
        if plain:
            n = size[ids]
            raw = data[_spread(at[ids], n)]
            cut = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(each)])]
            some = np.flatnonzero(each > 0)
            plain = len(raw) < 1 << 31 and bool((raw[cut[some]] == 0x20).all()) if len(some) else True
        if plain:
            keep = np.ones(len(raw) if len(ids) else 0, bool)
            keep[cut[some]] = False
            text = raw[keep] if len(ids) else np.zeros(0, np.uint8)
            offsets = (cut - np.concatenate([[0], np.cumsum(each > 0)])).astype(np.int32)
            valid = lists.is_valid()
            mask = None if lists.null_count == 0 else pa.array(valid).buffers()[1]
            made = pa.Array.from_buffers(pa.binary(), len(lists), [mask, pa.py_buffer(offsets), pa.py_buffer(text)])
            try:
                return made.cast(pa.string())
            except pa.ArrowInvalid:
                pass  # bytes that are no text are replaced one by one
        return pa.array([None if not x.is_valid else self.decode(x.values.to_numpy().tolist()) for x in lists], pa.string())


class Codec(Decoder):
    def __init__(self, path: str, seed: int, dropout: float, memo_words: int = MEMO_WORDS) -> None:
        super().__init__(path)
        best = sorted(self.ids, key=lambda p: (-self.pieces.scores[p], self.ids[p]))
        self.rank = {p: r for r, p in enumerate(best)}
        joined = {m[0][1] for p in self.ids for m in _JOINED.finditer(p)}
        self.parts = {c for c in map(chr, range(33, 127)) if not c.isalnum()} - joined  # marks that no piece joins to a letter
        self.key = hashlib.blake2b(str(seed).encode(), digest_size=32).digest()
        self.bound = int(dropout * (1 << 53))
        self.memo_words, self.memo = memo_words, Words(self._split)
        # For many words at once: ids of single characters, and ranks of pairs of pieces.
        self.single = np.full((1 << 16) + 1, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1 and ord(piece) < 1 << 16:
                self.single[ord(piece)] = i
        pairs = {(self.ids[p[:i]] << 32) + self.ids[p[i:]]: r for p, r in self.rank.items() for i in range(1, len(p)) if p[:i] in self.ids and p[i:] in self.ids}
        self.pairs = Pairs(pairs)
        self.merged = np.array([self.ids[p] for p in best], np.int32)

    def _hash(self, *parts) -> bytes:
        return hashlib.blake2b(repr(parts).encode(), digest_size=8, key=self.key).digest()

    def _merged(self, symbols: list[str], own: int, bound: int | None = None) -> list[str]:
        """The symbols left of a part whose key is ``own``."""
        if len(symbols) > SHORT:
            return self._heap_merged(symbols, own, bound)
        rank, bound = self.rank.get, self.bound if bound is None else bound
        place = list(range(len(symbols)))
        pairs = [rank(a + b, _NONE) for a, b in itertools.pairwise(symbols)]
        while pairs and (best := min(pairs)) != _NONE:
            i = pairs.index(best)  # the leftmost of the best
            if bound and _mix(own, place[i], best) < bound:
                pairs[i] = _NONE
                continue
            symbols[i] += symbols.pop(i + 1)
            del place[i + 1], pairs[i]
            if i:
                pairs[i - 1] = rank(symbols[i - 1] + symbols[i], _NONE)
            if i < len(pairs):
                pairs[i] = rank(symbols[i] + symbols[i + 1], _NONE)
        return symbols

    def _heap_merged(self, symbols: list[str], own: int, bound: int | None = None) -> list[str]:
        n, bound = len(symbols), self.bound if bound is None else bound
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right < n:
                found = self.rank.get(symbols[left] + symbols[right])
                if found is not None:
                    heapq.heappush(agenda, (found, left, right, len(symbols[left]) + len(symbols[right])))
        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            best, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue  # a part has been merged since
            if bound and _mix(own, left, best) < bound:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            propose(before[left], left)
            propose(left, after[left])
        return [s for s in symbols if s]

    def _ids(self, symbols: list[str]) -> bytes:
        out: list[int] = []
        for s in symbols:
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            else:
                out += [self.pieces.bytes[b] for b in (MARK if s == _LITERAL else s).encode()]
        return struct.pack(f"<{len(out)}H", *out)

    @staticmethod
    def _symbols(part: str) -> list[str]:
        if " " not in part[1:] and MARK not in part:
            return list(part.replace(" ", MARK))
        return [MARK if c == " " else _LITERAL if c == MARK else c for c in part]

    def _split(self, word: str) -> str | list[str]:
        """The text of a word after its mark, or, if a space ends it, of one without a mark.
        A line end is in no piece and some marks join no letter, so words part there: such
        a word gives the words it has."""
        if "\n" in word and word != "\n ":
            first, *lines = word.split("\n")
            return [first, *itertools.chain.from_iterable(("\n ", x + " ") if x else ("\n ",) for x in lines)]
        bare = word[-1:] == " " and word.strip(" ") != ""
        own = word[:-1] if bare else word
        if self.parts and own and not own[-1].isalnum() and (marked := _MARKED.fullmatch(own)) and marked[2][0] in self.parts:
            return [marked[1] + word[len(own):], marked[2] + " "]
        return own if bare else " " + own

    def _part(self, own: int, part: str) -> bytes:
        """Ids of a part whose key is ``own``."""
        return self._ids(self._merged(self._symbols(part), own))

    def _many(self, own, parts: Sequence[str]) -> list[bytes]:
        """What ``_part`` gives for each; one key for all, or one for each."""
        ids, n, _, _ = self._segmented(np.broadcast_to(np.asarray(own, np.uint64), len(parts)), parts, self.bound)
        cut = np.concatenate([[0], np.cumsum(n) * 2]).tolist()
        raw = ids.astype("<u2").tobytes()
        return [raw[a:b] for a, b in itertools.pairwise(cut)]

    def _segmented(self, own: np.ndarray, parts: Sequence[str], bound: int, skips: np.ndarray | None = None):
        """(ids, their number a part, candidates taken, their number a part) under the parts'
        keys, or with the candidates skipped that ``skips`` has bits for.  ``ROWS`` parts of like length take their next candidate at the same time, as
        ``_merged`` does for one; longer ones than ``SHORT`` do so alone, without candidates."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        order = np.argsort(size, kind="stable")
        short = int(np.searchsorted(size[order], SHORT, "right"))
        found = [self._rows(own[rows] if skips is None else skips[rows], [parts[i] for i in rows.tolist()], size[rows], bound, skips is not None)
                 for rows in (order[a:min(a + ROWS, short)] for a in range(0, short, ROWS))]
        for i in order[short:].tolist():
            ids = np.frombuffer(self._ids(self._merged(self._symbols(parts[i]), int(own[i]), bound)), "<u2")
            found.append((ids, np.array([len(ids)]), np.zeros(0, np.uint32), np.zeros(1, np.int64)))
        if not found:
            return np.zeros(0, np.uint16), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids, n, codes, m = (np.concatenate(x) for x in zip(*found, strict=True))
        back = np.argsort(order)
        return ids[_spread((np.cumsum(n) - n)[back], n[back])], n[back], codes[_spread((np.cumsum(m) - m)[back], m[back])], m[back]

    def _rows(self, own: np.ndarray, parts: Sequence[str], size: np.ndarray, bound: int, fixed: bool = False):
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        row = np.repeat(np.arange(len(parts)), size)
        single = self.single[np.minimum(points, 1 << 16)]
        single[points == 32] = self.single[ord(MARK)]
        odd = np.flatnonzero((single < 0) | (points == ord(MARK)))
        if len(odd):
            own_id = {c: _BYTES + c if chr(c) == MARK else self.ids.get(MARK if c == 32 else chr(c), _BYTES + (ord(MARK) if c == 32 else c)) for c in set(points[odd].tolist())}
            single[odd] = [own_id[c] for c in points[odd].tolist()]
        symbols = np.full((len(parts), int(size.max()) + 1), -1, np.int32)
        symbols[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = single
        out = np.full(symbols.shape, -1, np.int32)
        rows = np.arange(len(parts))
        place = np.broadcast_to(np.arange(symbols.shape[1], dtype=np.int16), symbols.shape).copy()
        columns = np.arange(symbols.shape[1])
        taken: list[tuple[np.ndarray, np.ndarray]] = []

        rank = self.pairs.get
        ranks = np.full(symbols.shape, _NONE, np.int32)
        ranks[:, :-1] = rank(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            i = ranks.argmin(axis=1)  # the leftmost of the best
            best = ranks[np.arange(len(rows)), i]
            done = best == _NONE
            if done.any():
                out[rows[done], :symbols.shape[1]] = symbols[done]
                rows, symbols, place, ranks, own, i, best = (x[~done] for x in (rows, symbols, place, ranks, own, i, best))
                if not len(rows):
                    break
                wide = int((symbols >= 0).sum(axis=1).max()) + 1
                if wide < symbols.shape[1]:
                    symbols, place, ranks, columns = symbols[:, :wide].copy(), place[:, :wide].copy(), ranks[:, :wide].copy(), columns[:wide]
            r = np.arange(len(rows))
            code = place[r, i].astype(np.uint32) << np.uint32(16) | best.astype(np.uint32)
            taken.append((rows, code))
            m = r
            if bound or fixed:
                step = len(taken) - 1  # all rows have taken as many
                skip = _skipped(own, code, bound) if not fixed else own >> np.uint64(step) & np.uint64(1) > 0 if step < _BITS else np.zeros(len(rows), bool)
                ranks[r[skip], i[skip]] = _NONE
                m, i, best = r[~skip], i[~skip], best[~skip]
                if not len(m):
                    continue
            symbols[m, i] = self.merged[best]
            # Without the symbol merged into its left; the last column stays empty.
            after = columns[:-1] >= i[:, None]
            ranks[m, :-1] = np.where(after, (own_ranks := ranks[m])[:, 1:], own_ranks[:, :-1])
            after[np.arange(len(m)), i] = False
            for x in (symbols, place):
                x[m, :-1] = np.where(after, (of := x[m])[:, 1:], of[:, :-1])
            ranks[m, i] = rank(symbols[m, i], symbols[m, i + 1])
            before = i > 0
            ranks[m[before], i[before] - 1] = rank(symbols[m[before], i[before] - 1], symbols[m[before], i[before]])
        left = out >= 0
        n, ids = left.sum(axis=1), out[left]
        if (out >= _BYTES).any():
            wide = [[self.pieces.bytes[b] for b in chr(x - _BYTES).encode()] if x >= _BYTES else [x] for x in ids.tolist()]
            n = np.bincount(np.repeat(np.arange(len(parts)), n), weights=[len(x) for x in wide], minlength=len(parts)).astype(np.int64)
            ids = np.array(list(itertools.chain.from_iterable(wide)))
        of = np.concatenate([np.zeros(0, np.int64), *(r for r, _ in taken)])
        codes = np.concatenate([np.zeros(0, np.uint32), *(c for _, c in taken)])
        return ids.astype(np.uint16), n, codes[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(parts))

    def forget(self) -> None:
        """The words kept so far go."""
        self.memo = Words(self._split)

    def encode_many(self, ids: list, texts: list[str]) -> list[bytes]:
        """Serialised 16-bit ids of whole texts."""
        flat, n = self.encoded(ids, texts)
        raw, cut = flat.astype("<u2").tobytes(), np.concatenate([[0], np.cumsum(n) * 2]).tolist()
        return [raw[a:b] for a, b in itertools.pairwise(cut)]

    def encoded(self, ids: list, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number a text) of whole texts."""
        memo = self.memo
        if len(memo) > self.memo_words or memo.chars > 64 * MEMO_WORDS or memo.codes.n > MEMO_CODES:
            self.forget()
            memo = self.memo
        numbers = [list(map(memo.__getitem__, words(t))) for t in texts]
        size = np.fromiter(map(len, numbers), np.int64, len(numbers))
        every = np.fromiter(itertools.chain.from_iterable(numbers), np.int64, int(size.sum()))
        if memo.several:
            every, n = memo.parted(every)
            size = np.diff(np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(size)])])
        memo.plant()
        flat, n = [np.zeros(0, np.uint16)], np.zeros(len(every), np.int64)
        draw = np.fromiter((int.from_bytes(self._hash(i), "little") for i in ids), np.uint64, len(ids))
        own = common.mix(np.repeat(draw, size) + _spread(np.zeros(len(size), np.int64), size).astype(np.uint64) * np.uint64(common.MULT))
        for a in range(0, len(every), DRAWS):
            found, n[a:a + DRAWS] = self._drawn(every[a:a + DRAWS], own[a:a + DRAWS])
            flat.append(found)
        return np.concatenate(flat), np.diff(np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(size)])])

    def _drawn(self, numbers: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number an occurrence) of words under their occurrences' keys."""
        memo = self.memo
        at, n = np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64)
        long = memo.size.data[numbers] > SHORT if self.bound else np.zeros(len(numbers), bool)
        alone = [np.flatnonzero(long)]
        rows = np.flatnonzero(~long)  # occurrences on their way, and the slots they are at
        slots = memo.root.data[numbers[rows]]
        while len(rows):
            bare = np.flatnonzero(memo.node.data[slots] < 0)
            if len(bare):
                self._grow(slots[bare])
            node = memo.node.data[slots].astype(np.int64)
            found = node >= 0
            alone.append(rows[~found])
            rows, node = rows[found], node[found]
            get = lambda k: memo.at[k].data[node]  # noqa: E731, B023
            at[rows], n[rows] = get("ids"), get("n_ids")
            if not self.bound:
                break
            begin = get("begin")
            left = get("n_codes") - begin
            which = np.repeat(np.arange(len(rows)), left)
            place = _spread(begin, left)
            skip = np.flatnonzero(_skipped(own[rows[which]], memo.codes.data[np.repeat(get("codes"), left) + place], self.bound))
            which, first = np.unique(which[skip], return_index=True)
            slots = get("slots")[which] + place[skip[first]]
            rows = rows[which]
        again = np.concatenate(alone)
        ids, size, _, _ = self._segmented(own[again], [memo.parts[i] for i in numbers[again].tolist()], self.bound)
        at[again], n[again] = memo.ids.n + np.cumsum(size) - size, size
        return np.concatenate([memo.ids.data[:memo.ids.n], ids])[_spread(at, n)], n

    def _grow(self, slots: np.ndarray) -> None:
        """Nodes for the slots that are met a second time; without dropout for all."""
        memo = self.memo
        slots, count = np.unique(slots, return_counts=True)
        state = memo.node.data[slots]
        make = slots[(state == _MET) | (state == _NEW) & ((count > 1) | (self.bound == 0))]
        memo.node.data[slots[state == _NEW]] = _MET
        if len(make) >= FEW or not self.bound:
            part, skips, _ = memo.meaning(make)
            memo.add(make, *self._segmented(np.zeros(len(make), np.uint64), [memo.parts[i] for i in part.tolist()], 0, skips))

    def encode(self, doc_id, text: str) -> bytes:
        return self.encode_many([doc_id], [text])[0]


@functools.lru_cache(maxsize=2)
def codec_of(path: str, seed: int, dropout: float, memo_words: int = MEMO_WORDS) -> Codec:
    """One codec per worker process, so that the model is read once."""
    return Codec(path, seed, dropout, memo_words)


@functools.lru_cache(maxsize=1)
def decoder_of(path: str) -> Decoder:
    return Decoder(path)


def _forget() -> None:
    codec_of.cache_clear()
    decoder_of.cache_clear()


def encode(docs: DataFrame, model: str, seed: int = 0, dropout: float = 0.1, column: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``column``."""
    common.small_batches(docs.sparkSession)

    def made(name):
        @common.released
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common.claim("merge_dropout", _forget)
            codec = codec_of(model, seed, dropout)
            for batch in batches:
                _, offsets = common.utf8(batch.column(name("text")))
                for a, b in common.runs(offsets):
                    part = batch.slice(a, b - a)
                    texts = part.column(name("text"))
                    found, n = codec.encoded(part.column(name("doc_id")).to_pylist(), [t or "" for t in texts.to_pylist()])
                    cut = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                    yield common.with_columns(part, pa.ListArray.from_arrays(cut, pa.array(found.astype(np.int32)), mask=texts.is_null()))
            codec.forget()  # workers take turns, so all that wait would hold words too
        return run
    return common.extended(docs, made, **{column: "array<int>"})


def decode(rows: DataFrame, model: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids in ``column``."""

    def made(name):
        @common.released
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            common.claim("merge_dropout", _forget)
            codec = decoder_of(model)
            for batch in batches:
                size = np.nan_to_num(batch.column(name(ids)).value_lengths().to_numpy(zero_copy_only=False))
                for a, b in common.runs(np.concatenate([[0], np.cumsum(size)]), DECODED):
                    part = batch.slice(a, b - a)
                    yield common.with_columns(part, codec.decode_many(part.column(name(ids))))
        return run
    return common.extended(rows, made, **{column: "string"})
