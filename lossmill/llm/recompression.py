"""Run-length grammars by recompression, and extensions answered from them.

Two steps alternate until one symbol is left. A block step replaces every maximal
block of one symbol by a symbol for it and its length. A pair step divides the
symbols into two classes and replaces every pair of a first-class symbol and a
second-class one by a symbol of its own. Whether a boundary survives a step depends
on the two symbols beside it only, so equal stretches are parsed alike but for one
symbol at each end. How far two positions agree is therefore found by walking up
the levels, at most one symbol or block per level, and down again where they differ.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .textscan import mix

#: Divisions into classes that a pair step tries; the one with most pairs is taken.
TRIES = 4


@dataclass
class Level:
    """Symbols with an end mark, and how they are grouped: first child of each group, group of each symbol."""

    symbols: np.ndarray
    first: np.ndarray
    up: np.ndarray
    blocks: bool

    def left_in_group(self, at: np.ndarray) -> np.ndarray:
        group = self.up[at]
        return self.first[np.minimum(group + 1, len(self.first) - 1)] - at


def _numbered(keys: np.ndarray, after: int) -> tuple[np.ndarray, int]:
    """New symbols for keys, numbered from `after` on."""
    found, place = np.unique(keys, return_inverse=True)
    return after + place, after + len(found)


def _grouped(symbols: np.ndarray, begins: np.ndarray, blocks: bool) -> Level:
    first = np.append(np.flatnonzero(begins), len(symbols))
    up = np.append(np.cumsum(begins) - 1, len(first) - 1)
    return Level(np.append(symbols, -1), first, up, blocks)


class Grammar:
    """The levels of a sequence of symbols 0, 1, ..."""

    def __init__(self, symbols: np.ndarray):
        symbols = np.asarray(symbols, dtype=np.int64)
        self.levels: list[Level] = []
        known, turn = int(symbols.max(initial=-1)) + 1, 0
        while len(symbols) > 1:
            begins = np.append(True, symbols[1:] != symbols[:-1])
            if not begins.all():
                level = _grouped(symbols, begins, True)
                size = np.diff(level.first)
                symbols = symbols[level.first[:-1]]
                long = size > 1
                symbols[long], known = _numbered(symbols[long] * (int(size.max()) + 1) + size[long], known)
                self.levels.append(level)
                continue
            best = None
            for _ in range(TRIES):
                turn += 1
                ahead = (mix(symbols.astype(np.uint64) + np.uint64(turn << 40)) & np.uint64(1)).astype(bool)
                pairs = ahead[:-1] & ~ahead[1:]
                if best is None or pairs.sum() > best.sum():
                    best = pairs
            if not best.any():
                continue
            level = _grouped(symbols, np.append(True, ~best), False)
            at = np.flatnonzero(best)
            fresh, total = _numbered(symbols[at] * known + symbols[at + 1], known)
            symbols = symbols[level.first[:-1]]
            symbols[level.up[at]] = fresh
            known = total
            self.levels.append(level)
        self.levels.append(Level(np.append(symbols, -1), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), False))

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols agree from positions i and j on (i and j differ)."""
        a, b = np.array(i, dtype=np.int64), np.array(j, dtype=np.int64)
        active, stopped = np.arange(len(a)), []
        for level in self.levels[:-1]:
            at, other = a[active], b[active]
            aligned = (level.first[level.up[at]] == at) & (level.first[level.up[other]] == other)
            same = level.symbols[at] == level.symbols[other]
            stop = ~aligned & ~same
            moving = ~aligned & same
            step = np.ones(len(at), dtype=np.int64)
            if level.blocks:
                left, left_other = level.left_in_group(at), level.left_in_group(other)
                step = np.minimum(left, left_other)
                stop |= moving & (left != left_other)
            at, other = at + np.where(moving, step, 0), other + np.where(moving, step, 0)
            a[active], b[active] = at, other
            stopped.append(active[stop])
            active = active[~stop]
            a[active], b[active] = level.up[a[active]], level.up[b[active]]
        for level, joining in zip(reversed(self.levels[:-1]), reversed(stopped)):
            at, other = level.first[a[active]], level.first[b[active]]
            same = level.symbols[at] == level.symbols[other]
            step = np.ones(len(at), dtype=np.int64)
            if level.blocks:
                step = np.minimum(level.left_in_group(at), level.left_in_group(other))
            a[active], b[active] = at + np.where(same, step, 0), other + np.where(same, step, 0)
            active = np.concatenate([active, joining])
        return a - np.asarray(i)
