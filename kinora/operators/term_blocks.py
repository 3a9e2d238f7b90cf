"""Terms of a block of documents as sorted numbers, with Arrow and NumPy.

A term is a word, or two adjacent words of a text.  The words of a block stand in sorted
order, and a term's key is its word's place, or ``(place + 1) * words + place of the next
one``: so counting is one sort of numbers, and strings are made once a distinct term.  Keys
depend on the block's texts only, not on the order in which they come: a block that is
counted again has its terms in the same places, and what was found out about them can come
back without them, as plain lists of numbers.
"""

from __future__ import annotations

import ctypes
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from kinora.functions.stopwords import ENGLISH_STOP_WORDS

# FIXED VALUE: what stands between the tokens of ``tfidf.TOKEN_PATTERN``.
GAP_PATTERN = r"[^\p{L}\p{N}_]+"
MIN_TOKEN = 2            # characters
MOST = (1 << 63) - 1     # the largest number that holds a key and a document
SLICE = 1 << 17          # rows of a batch that is given back

LISTS_SCHEMA = "b int, p int, n binary, sizes binary, terms binary"
FREQUENCIES_SCHEMA = "b int, p int, df binary"
NUMBERED_SCHEMA = f"{FREQUENCIES_SCHEMA}, number binary"


class Counted(NamedTuple):
    ids: pa.Array        # the documents, each once, null too
    words: pa.Array      # in sorted order
    terms: np.ndarray    # keys of the distinct terms, ascending
    n: np.ndarray        # documents that hold the term
    doc: np.ndarray      # of each row (term, document), by terms: the place in ids
    count: np.ndarray    # and how often the document has the term


def release() -> None:
    """Give what this worker has freed back to the system, as far as its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run):
    """``run`` over one or two whole tables, and ``release``: workers wait for further tasks
    beside those at work.  Spark goes by the number of arguments."""
    def one(table: pa.Table) -> pa.Table:
        out = run(table)
        release()
        return out

    def two(block: pa.Table, found: pa.Table) -> pa.Table:
        out = run(block, found)
        release()
        return out
    return two if run.__code__.co_argcount == 2 else one


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, values.size), bool), values[1:] != values[:-1]]))


def _numbers(array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def count_block(ids: pa.ChunkedArray, texts: pa.ChunkedArray, ngram_max: int = 2) -> Counted:
    """Term counts of ``texts`` as ``tfidf.spaced`` gives them; rows of one id are one document, whose texts
    are not joined."""
    ids = ids.combine_chunks().dictionary_encode(null_encoding="encode")
    split = [pc.split_pattern_regex(c, GAP_PATTERN) for c in texts.cast(pa.string()).chunks]
    sizes = [_numbers(pc.fill_null(pc.list_value_length(c), 0)) for c in split]
    row = np.repeat(np.arange(len(texts)), np.concatenate(sizes)) if sizes else np.zeros(0, np.int64)
    tokens = pa.chunked_array([c.flatten() for c in split], pa.string()).dictionary_encode().combine_chunks()
    found = tokens.dictionary
    kept = np.flatnonzero(~_numbers(pc.is_in(found, pa.array(ENGLISH_STOP_WORDS))) & (_numbers(pc.utf8_length(found)) >= MIN_TOKEN))
    words = found.take(pa.array(kept))
    order = _numbers(pc.sort_indices(words))
    words, v = words.take(pa.array(order)), len(words)
    place = np.full(len(found), -1, np.int64)
    place[kept[order]] = np.arange(v)
    key = place[_numbers(tokens.indices)]
    row, key = row[key >= 0], key[key >= 0]
    doc, d = _numbers(ids.indices).astype(np.int64)[row], max(1, len(ids.dictionary))
    if ngram_max >= 2:
        at = np.flatnonzero(row[1:] == row[:-1])
        key, doc = np.concatenate([key, (key[at] + 1) * v + key[at + 1]]), np.concatenate([doc, doc[at]])
    distinct = None
    if (v + 1) * v * d > MOST:  # numbered anew, so that a term and a document fit one number
        distinct, key = np.unique(key, return_inverse=True)
    both = key * d + doc
    both.sort()
    at = _starts(both)
    count = np.diff(at, append=both.size).astype(np.int32)
    both = both[at]
    key, doc = both // d, (both % d).astype(np.int32)
    at = _starts(key)
    terms = key[at] if distinct is None else distinct[key[at]]
    return Counted(ids.dictionary, words, terms, np.diff(at, append=key.size), doc, count)


def term_strings(words: pa.Array, terms: np.ndarray) -> pa.Array:
    """The terms of ascending or other keys, as strings."""
    first, last = np.divmod(terms, max(1, len(words)))
    two = first > 0
    if not two.any():
        return words.take(pa.array(last))
    pairs = pc.binary_join_element_wise(words.take(pa.array(first[two] - 1)), words.take(pa.array(last[two])), " ")
    if two.all():
        return pairs
    both = pa.concat_arrays([words.take(pa.array(last[~two])), pairs])
    at = np.empty(len(terms), np.int64)
    at[np.concatenate([np.flatnonzero(~two), np.flatnonzero(two)])] = np.arange(len(terms))
    return both.take(pa.array(at))


def parts_of(words: pa.Array, terms: np.ndarray, parts: int) -> np.ndarray:
    """A part from 0 to ``parts`` for each term, the same in all blocks."""
    h = pd.util.hash_array(_numbers(words).astype(object), categorize=False)
    first, last = np.divmod(terms, max(1, len(words)))
    mixed = h[last] + np.where(first > 0, h[first - 1] * np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.int64)


def _cut(buffer: pa.Buffer, offsets: np.ndarray) -> pa.Array:
    """The bytes between the offsets, one value each."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), buffer])


def _ranges(c: Counted, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the order of the terms by part, parts that have terms, their bounds in that order)."""
    part = parts_of(c.words, c.terms, parts)
    order = np.argsort(part, kind="stable")
    at = _starts(part[order])
    return order, part[order][at], np.append(at, len(order))


def term_lists(parts: int, ngram_max: int):
    """(b, doc_id, text) of a block -> for each part p of the terms those of the block, by
    key: how many documents have the term, the bytes of each string, and the strings,
    compressed, since they are most of what is shuffled."""
    @released
    def run(block: pa.Table) -> pa.Table:
        c = count_block(block["doc_id"], block["text"], ngram_max)
        order, p, bounds = _ranges(c, parts)
        strings = term_strings(c.words, c.terms[order])
        ends = np.frombuffer(strings.buffers()[1], np.int32, len(strings) + 1) if len(strings) else np.zeros(1, np.int32)
        return pa.table({"b": pa.repeat(pa.scalar(block["b"][0].as_py(), pa.int32()), len(p)), "p": pa.array(p, pa.int32()),
                         "n": _cut(pa.py_buffer(c.n[order].astype(np.int32)), bounds * 4),
                         "sizes": _cut(pa.py_buffer(np.diff(ends)), bounds * 4),
                         "terms": pa.array([pa.compress(strings.buffers()[2][i:j], "zstd", asbytes=True) for i, j in zip(ends[bounds[:-1]], ends[bounds[1:]])], pa.binary())})
    return run


def _joined(values: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_buffer() for v in values), np.int32)


def frequencies(numbered: bool = False):
    """``term_lists`` of one part -> for each list, the documents that have its terms in all
    blocks; ``numbered``: and a number for each term that two documents have at least, the
    same in all lists of the part, and in a recomputed task: they are in order of the lists."""
    @released
    def run(lists: pa.Table) -> pa.Table:
        lists = lists.sort_by("b")
        sizes, n = _joined(lists["sizes"]), _joined(lists["n"])
        offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        bounds = np.concatenate([[0], np.cumsum([len(v.as_buffer()) for v in lists["n"]])])
        ends = offsets[bounds // 4]
        data = b"".join(pa.decompress(v.as_buffer(), int(size), "zstd") for v, size in zip(lists["terms"], np.diff(ends)))
        strings = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        code = _numbers(strings.dictionary_encode().indices)
        df = np.bincount(code, weights=n)
        out = {"b": lists["b"], "p": lists["p"], "df": _cut(pa.py_buffer(df[code].astype(np.int32)), bounds)}
        if numbered:
            shared = df > 1
            number = np.where(shared, np.cumsum(shared) - 1, 0)
            out["number"] = _cut(pa.py_buffer(number[code].astype(np.int32)), bounds)
        return pa.table(out)
    return run


def frequencies_in(c: Counted, parts: int, found: pa.Table, numbered: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(documents that have each term of the block, its number), from the block's rows of
    ``frequencies``."""
    order, p, bounds = _ranges(c, parts)
    found = found.sort_by("p")
    df = _joined(found["df"])
    if len(df) != len(c.terms) or not np.array_equal(p, _numbers(found["p"])):
        raise ValueError("a block's documents differ from those that were counted")
    at = np.empty(len(df), np.int64)
    at[order] = np.arange(len(df))
    if not numbered:
        return df.astype(np.int64)[at], None
    number = (np.repeat(p.astype(np.int64), np.diff(bounds)) << 32) | _joined(found["number"])
    return df.astype(np.int64)[at], number[at]


def raw_weights(c: Counted, df: np.ndarray, n_docs: int) -> np.ndarray:
    """The weight of each row before the norm: tf * idf."""
    idf = np.log((1 + n_docs) / (1 + df)) + 1.0
    return (1.0 + np.log(c.count)) * np.repeat(idf, c.n)


def weights(parts: int, ngram_max: int):
    """(b, doc_id, text) of a block and its (b, p, df, n_docs) -> (doc_id, term, weight)."""
    @released
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        c = count_block(block["doc_id"], block["text"], ngram_max)
        df, _ = frequencies_in(c, parts, found)
        w = raw_weights(c, df, found["n_docs"][0].as_py()) if len(df) else np.zeros(0)
        w /= np.sqrt(np.bincount(c.doc, w * w, len(c.ids)))[c.doc]
        term = np.repeat(np.arange(len(c.terms)), c.n)
        schema = pa.schema([("doc_id", c.ids.type), ("term", pa.string()), ("weight", pa.float64())])
        batches = []
        for at in range(0, len(w), SLICE):
            own = term[at:at + SLICE]
            strings = term_strings(c.words, c.terms[own[0]:own[-1] + 1])
            batches.append(pa.record_batch([c.ids.take(pa.array(c.doc[at:at + SLICE])), strings.take(pa.array(own - own[0])),
                                            pa.array(w[at:at + SLICE])], schema=schema))
        return pa.Table.from_batches(batches, schema)
    return run


def vectors(parts: int, ngram_max: int, rare: int):
    """(b, doc_id, text) of a block and its (b, p, df, number, n_docs) -> a row for each
    document that shares a term: ``terms`` rarest first, their weights ``w`` before the
    norm, the norm of all its terms, how many of ``terms`` at most ``rare`` documents have,
    the part of the norm that is of these and of the others, and ``reach``, the sum of
    squares of the rare ones, each counted once for every other document that has it."""
    @released
    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        c = count_block(block["doc_id"], block["text"], ngram_max)
        df, number = frequencies_in(c, parts, found, numbered=True)
        w = raw_weights(c, df, found["n_docs"][0].as_py()) if len(df) else np.zeros(0)
        term, n = np.repeat(np.arange(len(c.terms), dtype=np.int32), c.n), len(c.ids)
        square, often = w * w, df[term]
        norm = np.sqrt(np.bincount(c.doc, square, n))
        few, many = (often > 1) & (often <= rare), often > rare
        total = lambda rows, x: np.bincount(c.doc[rows], x[rows], n)
        place = np.empty(len(df), np.int64)
        place[np.lexsort((number, df))] = np.arange(len(df))
        kept = np.flatnonzero(often > 1)
        kept = kept[np.argsort(c.doc[kept].astype(np.int64) * max(1, len(df)) + place[term[kept]])]
        size = np.bincount(c.doc[kept], minlength=n)
        own = np.flatnonzero(size)
        ends = pa.array(np.concatenate([[0], np.cumsum(size[own])]), pa.int32())
        lists = lambda x: pa.ListArray.from_arrays(ends, pa.array(x))
        return pa.table({"doc_id": c.ids.take(pa.array(own)), "terms": lists(number[term[kept]]), "w": lists(w[kept]), "norm": norm[own],
                         "n_rare": pa.array(np.bincount(c.doc[few], minlength=n)[own], pa.int32()), "rare": np.sqrt(total(few, square))[own] / norm[own],
                         "rest": np.sqrt(total(many, square))[own] / norm[own], "reach": total(few, square * (often - 1))[own] / norm[own] ** 2})
    return run
