"""Content-defined positions in byte strings.

A byte position is an anchor of a start ``p`` if its 16-byte gram hashes lowest among the ``WINDOW``
grams from ``p`` on, the leftmost of equal ones. Which position that is depends on the bytes after
``p`` alone, so equal strings have their anchors at equal places: the anchors are a difference cover
of all starts, by content instead of by remainders of the position.
"""

from __future__ import annotations

import numpy as np

from weirstone.llm.arrays import Prefixes

GRAM = 16
WINDOW = 136
SPOT = np.uint64((1 << 24) - 1)


def anchor_ranges(data: np.ndarray, offsets: np.ndarray, length: int, hashes: Prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, position, and first and last start of every anchor, for starts of ``length`` bytes.

    Positions count from the beginning of ``data`` (below 16 MB, or one row at a time in parts).
    """
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    place = np.arange(n - GRAM + 1)
    key = (hashes.windows(place, place + GRAM) & ~SPOT) | place.astype(np.uint64)
    span = 1
    while span * 2 <= WINDOW:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    rest = WINDOW - span
    if rest:
        key = np.minimum(key[:-rest], key[rest:])
    starts = np.flatnonzero(np.repeat(offsets[1:] - length, np.diff(offsets)) >= np.arange(n))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    anchor = (key[starts] & SPOT).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.concatenate([begin[1:], [len(starts)]]) - 1
    row = np.searchsorted(offsets, starts[begin], side="right") - 1
    return row, anchor[begin], starts[begin], starts[last]
