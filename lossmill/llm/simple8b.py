"""Simple-8b: integers packed into 64-bit words, a few selectors for how many share one.

The top four bits of a word select count and width of the values in the rest.
Selector 0 is an escape: the whole next word is one value, for values of more than
60 bits. Values are coded in blocks; a block starts a new word and the offsets of
the blocks are kept, so that all blocks are coded and decoded side by side.
"""

from __future__ import annotations

import numpy as np

BLOCK = 128

# Fixed values of the code: values per word and bits per value, selectors 1 to 14.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if len(values) == 0 or values.max() < 1 << 52:
        return np.frexp(values.astype(np.float64))[1].astype(np.int8)  # exact so far
    high = (values >> np.uint64(32)).astype(np.float64)
    low = (values & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1]).astype(np.int8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """For each place of each block, the selector that takes most values from there."""
    bits = np.zeros((len(values), BLOCK + int(COUNTS.max())), dtype=np.int8)
    bits[:, :BLOCK] = _bits(values.reshape(-1)).reshape(values.shape)
    chosen = np.zeros((len(values), BLOCK), dtype=np.int8)
    # Most bits among the next `width` values of each place; two such windows that
    # overlap make a wider one.
    widest, width = bits, 1
    for selector in range(len(COUNTS) - 1, 0, -1):
        count = int(COUNTS[selector])
        while width < count:
            step = min(width, count - width)
            widest = np.maximum(widest[:, : widest.shape[1] - step], widest[:, step:])
            width += step
        chosen[widest[:, :BLOCK] <= WIDTHS[selector]] = selector
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each block the number of the word at which it starts (one more for the end)."""
    size = len(values)
    blocks = -(-size // BLOCK)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint64)
    padded[:size] = values
    padded = padded.reshape(blocks, BLOCK)
    chosen = _selectors(padded)
    padded = np.pad(padded, ((0, 0), (0, int(COUNTS.max()))))
    lengths = np.full(blocks, BLOCK)
    if blocks:
        lengths[-1] = size - (blocks - 1) * BLOCK
    lane, place = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    lanes, places = [], []
    while len(lane):
        lanes.append(lane)
        places.append(place)
        place = place + COUNTS[chosen[lane, place]]
        more = place < lengths[lane]
        lane, place = lane[more], place[more]
    if not lanes:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    lane, place = np.concatenate(lanes), np.concatenate(places)
    order = np.argsort(lane, kind="stable")
    lane, place = lane[order], place[order]
    selector = chosen[lane, place]
    taken = 1 + (selector == 0)
    ends = np.cumsum(taken)
    out = np.zeros(int(ends[-1]), dtype=np.uint64)
    at = ends - taken
    for kind in np.unique(selector):
        which = np.flatnonzero(selector == kind)
        if kind == 0:
            out[at[which] + 1] = padded[lane[which], place[which]]
            continue
        word = np.full(len(which), int(kind) << 60, dtype=np.uint64)
        for i in range(COUNTS[kind]):
            word |= padded[lane[which], place[which] + i] << np.uint64(i * WIDTHS[kind])
        out[at[which]] = word
    return out, np.append(0, ends[np.append(np.flatnonzero(np.diff(lane)), len(lane) - 1)])


def decode(coded: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """The values again."""
    values = np.zeros(size, dtype=np.uint64)
    blocks = len(offsets) - 1
    at, place = offsets[:-1].astype(np.int64), np.zeros(blocks, dtype=np.int64)
    lane = np.arange(blocks)
    lengths = np.full(blocks, BLOCK)
    if blocks:
        lengths[-1] = size - (blocks - 1) * BLOCK
    heads, lanes, places = [], [], []
    selectors = (coded >> np.uint64(60)).astype(np.int64)
    while len(lane):
        heads.append(at)
        lanes.append(lane)
        places.append(place)
        kind = selectors[at]
        place, at = place + COUNTS[kind], at + 1 + (kind == 0)
        more = place < lengths[lane]
        lane, place, at = lane[more], place[more], at[more]
    if not heads:
        return values
    at, lane, place = np.concatenate(heads), np.concatenate(lanes), np.concatenate(places)
    kinds = selectors[at]
    for kind in np.unique(kinds):
        which = np.flatnonzero(kinds == kind)
        if kind == 0:
            values[lane[which] * BLOCK + place[which]] = coded[at[which] + 1]
            continue
        word, mask = coded[at[which]], np.uint64((1 << int(WIDTHS[kind])) - 1)
        for i in range(COUNTS[kind]):
            inside = place[which] + i < lengths[lane[which]]
            target = lane[which] * BLOCK + place[which] + i
            values[target[inside]] = ((word >> np.uint64(i * WIDTHS[kind])) & mask)[inside]
    return values
