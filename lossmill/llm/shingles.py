"""Sets of word runs of many texts at once."""

from __future__ import annotations

import numpy as np

from .textscan import gram_hashes, lower_ascii, words


def shingle_sets(data: np.ndarray, offsets: np.ndarray, length: int, fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin.

    A text with fewer words than a shingle has its whole sequence as one; a text
    without words has none.
    """
    found = words(lower_ascii(data) if fold_case else data, offsets)
    counts = np.diff(found.offsets)
    rows, hashes = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for size in range(1, length + 1):
        having = counts == size if size < length else counts >= length
        if not having.any():
            continue
        grams = gram_hashes(found.hashes, size)
        starts = np.concatenate([[0], np.cumsum(np.where(having, counts - size + 1, 0))])
        row = np.repeat(np.arange(len(counts)), np.diff(starts))
        at = found.offsets[row] + np.arange(len(row)) - starts[row]
        rows.append(row)
        hashes.append(grams[at])
    row, value = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[fresh], value[fresh]
    return value, np.searchsorted(row, np.arange(len(counts) + 1))
