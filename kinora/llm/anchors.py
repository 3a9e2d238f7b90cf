"""Anchors: places of a text that any two equal windows of ``WINDOW`` bytes share.

Of the ``WINDOW - GRAM + 1`` runs of ``GRAM`` bytes in a window the one of least hash,
leftmost first, is its anchor.  An anchor depends on the window's bytes alone, so equal
windows have equal anchors at the same place in them.  An anchor's context is what all
windows around it can cover, within its document.
"""

from __future__ import annotations

import numpy as np

from kinora.llm.common import BYTE_VALUE, MULT, POWERS, mix

WINDOW, GRAM = 50, 26
REACH = WINDOW - GRAM
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(place, document, gram hash, context start, context end, context hash) of each
    anchor of one run of fewer than 2**24 bytes; documents shorter than a window have none."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < WINDOW:
        return empty, empty, empty.view(np.uint64), empty, empty, empty.view(np.uint64)
    up, down = POWERS.upto(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:n], out=total[1:])
    gram = total[GRAM:] - total[:-GRAM]
    gram *= down[:n - GRAM + 1]
    gram *= np.uint64(MULT)  # its high bits depend on all others and go to the low ones
    gram ^= gram >> np.uint64(32)
    gram *= np.uint64(MULT)
    # Hash above, place below: the least is the leftmost of the least hashes.
    low = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    width, span = 1, REACH + 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    # Of windows that lie within one document.
    inside = np.zeros(n + 1, np.int64)
    long_ = np.flatnonzero(np.diff(offsets) >= WINDOW)
    np.add.at(inside, offsets[long_], 1)
    np.add.at(inside, offsets[long_ + 1] - WINDOW + 1, -1)
    place = (low[np.cumsum(inside[:n])[:len(low)] > 0] & _PLACE).astype(np.int64)
    place = place[np.concatenate([[True], place[1:] != place[:-1]])] if len(place) else place
    doc = np.searchsorted(offsets, place, "right") - 1
    start = np.maximum(place - REACH, offsets[doc])
    end = np.minimum(place + GRAM + REACH, offsets[doc + 1])
    context = mix((total[end] - total[start]) * down[start] + (place - start).astype(np.uint64) * np.uint64(MULT) + (end - start).astype(np.uint64))
    return place, doc, gram[place], start, end, context
