"""Periodic stretches of words, found on a harmonic grid and measured by a grammar.

A stretch of at least four periods of q words holds four multiples of q in a row, so
the word at all four is the same. Only such places of the grid (n/q of them for
every q) are candidates. How far a candidate's period reaches to both sides is
answered exactly by run-length grammars of the text and of its reverse; the texts of
a chunk that have candidates share one pair of grammars, each text closed by a
symbol of its own. No suffix structure is built. Documents do not meet, so nothing
is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .recompression import Grammar
from .textscan import Chunk, chunks, cover, words

#: Periods that a run holds at least, and its least number of words.
PERIODS = 4
LENGTH = 6
#: Places of the grid, and extensions, looked at together.
PIECE = 1 << 20

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.binary())])


def _candidates(symbols: np.ndarray, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods q of the grid at which `periods` words in a row, q apart, are equal."""
    n, found = len(symbols), [np.zeros((2, 0), dtype=np.int64)]
    last = (n - 1) // (periods - 1)
    low = 1
    while low <= last:
        # As many periods as fit a piece; at least one.
        high = min(last + 1, low + max(1, PIECE * low // n))
        period = np.arange(low, high)
        counts = (n - 1) // period - periods + 2
        place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        period = np.repeat(period, counts)
        place *= period
        for _ in range(periods - 1):
            same = symbols[place] == symbols[place + period]
            period, place = period[same], place[same] + period[same]
        found.append(np.array([place - (periods - 1) * period, period]))
        low = high
    place, period = np.concatenate(found, axis=1)
    return place, period


def runs_of(symbols: np.ndarray, offsets: np.ndarray, periods: int, length: int) -> list[np.ndarray]:
    """Runs of each text as rows start, length, period in order of start and period.

    A run is a stretch with least period q of at least `length` symbols and
    `periods` periods, maximal to both sides.
    """
    texts = len(offsets) - 1
    none = np.zeros((0, 3), dtype=np.int64)
    found = [_candidates(symbols[offsets[t] : offsets[t + 1]], periods) if offsets[t + 1] - offsets[t] >= length else none for t in range(texts)]
    having = [t for t in range(texts) if len(found[t]) == 2 and len(found[t][0])]
    result = [none] * texts
    if not having:
        return result
    kept = np.concatenate([symbols[offsets[t] : offsets[t + 1]] for t in having])
    _, kept = np.unique(kept, return_inverse=True)
    # Every text is followed by a symbol that occurs nowhere else.
    sizes = np.array([offsets[t + 1] - offsets[t] for t in having])
    whole = np.insert(kept, np.cumsum(sizes), int(kept.max()) + 1 + np.arange(len(having)))
    begins = np.cumsum(sizes + 1) - sizes - 1
    ahead, back = Grammar(whole), Grammar(whole[::-1])
    for t, begin in zip(having, begins):
        place, period = found[t]
        parts = []
        for first in range(0, len(place), PIECE):
            at, q = place[first : first + PIECE] + begin, period[first : first + PIECE]
            after = ahead.extensions(at, at + q)
            before = back.extensions(len(whole) - at, len(whole) - at - q)
            start, total = at - before - begin, before + q + after
            fits = (total >= length) & (total >= periods * q)
            parts.append(np.unique(np.array([start, total, q])[:, fits], axis=1))
        rows = np.unique(np.concatenate(parts, axis=1), axis=1).T
        # A stretch that also has a shorter period is reported with that one.
        fresh = np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
        rows = rows[fresh] if len(rows) else none
        result[t] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return result


def _rows(batches: Iterator[pa.RecordBatch], periods: int, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch["text"]):
            yield _chunk_rows(batch["doc_id"].slice(chunk.first, chunk.rows), chunk, periods, length)


def _chunk_rows(ids: pa.Array, chunk: Chunk, periods: int, length: int) -> pa.RecordBatch:
    found = words(chunk.data, chunk.offsets)
    runs = runs_of(found.hashes, found.offsets, periods, length)
    spans, collapsed = [], []
    for row, own in enumerate(runs):
        pieces = chunk.data[chunk.offsets[row] : chunk.offsets[row + 1]].tobytes().split()
        if len(own):
            gone = cover(own[:, 0] + own[:, 2], own[:, 0] + own[:, 1], len(pieces))
            pieces = compress(pieces, (~gone).tolist())
        spans.append([dict(zip(("start", "length", "period"), r)) for r in own.tolist()])
        collapsed.append(b" ".join(pieces))
    sizes = np.diff(found.offsets).astype(np.int64)
    return pa.RecordBatch.from_pydict({"doc_id": ids, "n_words": sizes, "runs": spans, "collapsed": collapsed}, schema=_ARROW)


def periodic_runs(docs: DataFrame, periods: int = PERIODS, length: int = LENGTH) -> DataFrame:
    """Rows doc_id, n_words, runs, collapsed: one for each row of the table.

    runs lists start (number of a word), length and period of every maximal run of at
    least `length` words and `periods` (two or more) repetitions, by start and
    period; runs of different periods may overlap. collapsed is the text with all
    of each run but its first period taken out, its words joined by one space.

    Whole texts are taken, however long. NULL, empty and blank texts have no words
    and no runs. Rows that repeat an id or have none are handled each by itself, other
    columns are ignored, and an empty table gives no rows. Words are compared by
    64-bit hashes.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(partial(_rows, periods=periods, length=length), SCHEMA)
