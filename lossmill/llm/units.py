"""Repeats of a fixed length, cut into units that equal texts cut alike.

Every window of `length` symbols is assigned the smallest hash among its runs of
`anchor` symbols. Consecutive windows that keep one and the same smallest run form
a unit. The choice depends on a window's content alone, so windows that are equal
anywhere in the corpus have equal anchors, and long repeats are cut into equal
units. A window without a partner under its anchor has no partner at all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .textscan import gram_hashes, mix, sliding_min


@dataclass
class Units:
    """Row in the chunk, first window relative to its text, number of windows, anchor hash."""

    row: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    anchor: np.ndarray


def units(symbols: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> Units:
    """Units of all texts of a chunk; texts shorter than a window have none."""
    sizes = np.diff(offsets)
    rows = np.flatnonzero(sizes >= length)
    if len(rows) == 0:
        none = np.zeros(0, dtype=np.int64)
        return Units(none, none, none, np.zeros(0, dtype=np.uint64))
    grams = gram_hashes(mix(symbols.astype(np.uint64) + np.uint64(1)), anchor)
    least = sliding_min(grams, length - anchor + 1)
    fresh = np.empty(len(least), dtype=bool)
    fresh[0] = True
    fresh[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
    firsts, stops = offsets[rows], offsets[rows + 1] - length + 1
    fresh[firsts] = True
    begins = np.flatnonzero(fresh)
    text = np.searchsorted(firsts, begins, side="right") - 1
    inside = (text >= 0) & (begins < stops[np.maximum(text, 0)])
    nexts = np.append(begins[1:], len(least))
    begins, nexts, text = begins[inside], nexts[inside], text[inside]
    nexts = np.minimum(nexts, stops[text])
    return Units(rows[text], begins - firsts[text], nexts - begins, least[begins])
