"""Windows of a fixed length that occur more than once, found by way of units.

Shared by the two operators that remove repeated substrings. `settle` exchanges one
small row per unit (hashes and a place, no text) and decides what equal units
decide; only units that share an anchor with a different unit are left, and of each
of those one occurrence, whose text `contents` fetches for the suffix structures.

Equal units of one batch are combined before the exchange, so a crowded unit
travels once per batch and not once per copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textscan import Chunk, chunks, gram_hashes, mix, range_hashes, signed, words
from .units import units

PLACES = "anchor long, unit long, key long, start int, windows int, state int"
#: Still to be compared; repeated elsewhere in the batch but kept as its one row; decided in the batch.
OPEN, SHARED, SETTLED = 0, 1, 2


def word_symbols(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, Callable]:
    found = words(chunk.data, chunk.offsets)
    return found.hashes, found.offsets, lambda a, b: range_hashes(chunk.data, found.starts[a], found.ends[b - 1])


def byte_symbols(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, Callable]:
    return chunk.data, chunk.offsets, lambda a, b: range_hashes(chunk.data, a, b)


SYMBOLS = {"words": word_symbols, "bytes": byte_symbols}


def _places(
    batches: Iterator[pa.RecordBatch], symbols: str, length: int, anchor: int, keep_first: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch["key"].to_numpy()
        parts = []
        for chunk in chunks(batch["text"]):
            values, offsets, hashes = SYMBOLS[symbols](chunk)
            found = units(values, offsets, length, anchor)
            if len(found.row):
                begin = offsets[found.row] + found.start
                content = hashes(begin, begin + found.windows + length - 1)
                parts.append((found.anchor, content, keys[chunk.first + found.row], found.start, found.windows))
        if not parts:
            continue
        anchors, content, key, start, count = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((start, key, content, anchors))
        anchors, content, key, start, count = (x[order] for x in (anchors, content, key, start, count))
        same = (anchors[1:] == anchors[:-1]) & (content[1:] == content[:-1])
        later, earlier = np.append(False, same), np.append(same, False)
        state = np.where(later, SETTLED, np.where(earlier & (not keep_first), SHARED, OPEN))
        columns = [signed(anchors), signed(content), key, start.astype(np.int32), count.astype(np.int32), state.astype(np.int32)]
        names = ["anchor", "unit", "key", "start", "windows", "state"]
        for first in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[first : first + (1 << 16)]) for x in columns], names)


def settle(docs: DataFrame, symbols: str, length: int, anchor: int, keep_first: bool) -> DataFrame:
    """Rows key, start, windows, repeated, candidate of all units that matter.

    repeated: every window of the unit occurs elsewhere (with `keep_first`: earlier).
    candidate: the one occurrence of its text (the first) that has to be compared
    with the other units of its anchor. Units with neither are left out.
    """
    found = docs.select("key", "text").mapInArrow(
        partial(_places, symbols=symbols, length=length, anchor=anchor, keep_first=keep_first), PLACES
    )
    # Rows decided in their batch join no comparison: they are dealt out by document.
    crowd = F.when(F.col("state") == SETTLED, F.xxhash64("key", "start")).otherwise(F.lit(0))
    found = found.withColumn("crowd", crowd)
    of_anchor = Window.partitionBy("anchor", "crowd")
    in_order = of_anchor.orderBy("unit", "key", "start")
    before, after = F.lag("unit").over(in_order), F.lead("unit").over(in_order)
    equal_before, equal_after = F.col("before").eqNullSafe(F.col("unit")), F.col("after").eqNullSafe(F.col("unit"))
    others = F.col("least") != F.col("most")
    found = (
        found.withColumn("before", before)
        .withColumn("after", after)
        .withColumn("least", F.min("unit").over(of_anchor))
        .withColumn("most", F.max("unit").over(of_anchor))
    )
    shared = equal_before if keep_first else equal_before | equal_after | (F.col("state") == SHARED)
    settled = F.col("state") == SETTLED
    return found.select(
        "key",
        "start",
        "windows",
        (settled | shared).alias("repeated"),
        (~settled & ~equal_before & others).alias("candidate"),
    ).where("repeated OR candidate")


def _contents(batches: Iterator[pa.RecordBatch], symbols: str, length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Units cut at their anchor: what stands before it, and the suffix that begins with it."""
    for batch in batches:
        lists = batch["units"]
        ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
        flat = lists.flatten()
        starts, counts = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
        keys = batch["key"].to_numpy()
        for chunk in chunks(batch["text"]):
            values, offsets, _ = SYMBOLS[symbols](chunk)
            grams = gram_hashes(mix(values.astype(np.uint64) + np.uint64(1)), anchor)
            rows: dict[str, list] = {"key": [], "start": [], "windows": [], "left": [], "suffix": []}
            for row in range(chunk.rows):
                for i in range(ends[chunk.first + row], ends[chunk.first + row + 1]):
                    begin = int(offsets[row]) + int(starts[i])
                    at = begin + int(np.argmin(grams[begin : begin + length - anchor + 1]))
                    rows["key"].append(keys[chunk.first + row])
                    rows["start"].append(starts[i])
                    rows["windows"].append(counts[i])
                    rows["left"].append(values[begin:at].tobytes())
                    rows["suffix"].append(values[at : begin + int(counts[i]) + length - 1].tobytes())
            yield pa.RecordBatch.from_pydict(
                rows,
                schema=pa.schema(
                    [("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("left", pa.binary()), ("suffix", pa.binary())]
                ),
            )


def contents(docs: DataFrame, settled: DataFrame, symbols: str, length: int, anchor: int) -> DataFrame:
    """Rows key, start, windows, left, suffix of the candidates; words travel as 8-byte hashes."""
    wanted = settled.where("candidate").groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("units"))
    return (
        docs.join(wanted, "key")
        .select("key", "text", "units")
        .mapInArrow(
            partial(_contents, symbols=symbols, length=length, anchor=anchor),
            "key long, start int, windows int, left binary, suffix binary",
        )
    )


def reverse_left(left: list[bytes], symbol_bytes: int, width: int) -> np.ndarray:
    """Matrix of the symbols before each anchor, nearest first, short rows filled up with zeros."""
    kind = np.uint8 if symbol_bytes == 1 else np.uint64
    matrix = np.zeros((len(left), max(width, 1)), dtype=kind)
    sizes = np.fromiter((len(x) // symbol_bytes for x in left), dtype=np.int64, count=len(left))
    flat = np.frombuffer(b"".join(left), dtype=kind)
    ends = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(left)), sizes)
    matrix[rows, np.repeat(ends, sizes) - 1 - np.arange(len(flat))] = flat
    return matrix


def interval_windows(
    common: np.ndarray, left: np.ndarray, before: np.ndarray, windows: np.ndarray, length: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Equal windows among sorted suffixes, for each number of symbols before the anchor.

    `common[i]` is the length of the prefix that suffix i shares with suffix i - 1. A
    window with `a` symbols before the anchor reaches `length - a` into the suffix,
    so its equals lie in one interval of suffixes that share so much (an internal
    node of that depth), with the same `a` symbols before. Yields a, the suffixes
    that have such a window, a number for equal ones, and the interval of each.
    """
    hashes = np.zeros(len(common), dtype=np.uint64)
    powers = np.ones(1, dtype=np.uint64)
    step = np.full(1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    for a in range(int(before.max(initial=-1)) + 1):
        if a:
            hashes = hashes + (left[:, a - 1].astype(np.uint64) + np.uint64(1)) * powers
            powers = powers * step
        active = np.flatnonzero((a <= before) & (a > before - windows))
        if len(active):
            interval = np.cumsum(common < length - a)
            yield a, active, mix(mix(hashes[active]) + interval[active].astype(np.uint64) * step), interval
