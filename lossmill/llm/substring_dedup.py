"""Repeated passages of words, by suffix trees that are split by prefix.

A passage is `length` consecutive words. Every word is removed that lies in a
passage whose words also start earlier, in a document with a smaller id or before
it in the same one.

Suffixes begin at the units' anchors (see `units`): equal passages have equal
anchors, so the anchor's words are the prefix by which suffixes are dealt out, and
one subtree holds all suffixes with that prefix. A prefix shared by more suffixes
than fit in memory is made longer, up to the whole passage, where the subtree is a
single node and only its first place is needed. Each subtree is a sorted block of
suffixes with the lengths of their common prefixes; its internal nodes are the
intervals that share at least so many words, and nodes deep enough, together with
the words before the anchor, are the repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .documents import keyed
from .kept import without
from .repeats import contents, interval_windows, reverse_left, settle
from .textscan import mix, range_hashes, signed

LENGTH = 20
ANCHOR = 6
#: Suffixes that one prefix may have before it is made longer, and that are handled at a time.
CROWD = 50_000

MARKS = "key long, start int, windows int"


def _suffix_matrix(suffixes: list[bytes], length: int) -> np.ndarray:
    matrix = np.zeros((len(suffixes), length), dtype=np.uint64)
    sizes = np.fromiter((min(len(x) // 8, length) for x in suffixes), dtype=np.int64, count=len(suffixes))
    flat = np.frombuffer(b"".join(x[: 8 * length] for x in suffixes), dtype=np.uint64)
    firsts = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(suffixes)), sizes)
    matrix[rows, np.arange(len(flat)) - firsts[rows]] = flat
    return matrix


def _tree(suffixes: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves in order, and the depth at which each parts from the leaf before it."""
    matrix = _suffix_matrix(suffixes, length)
    order = np.lexsort(matrix.T[::-1])
    matrix = matrix[order]
    differ = matrix[1:] != matrix[:-1]
    depth = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    return order, np.append(0, depth)


def run_marks(keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Single windows as runs of consecutive ones: key, start, windows."""
    order = np.lexsort((starts, keys))
    keys, starts = keys[order], starts[order]
    if len(keys) == 0:
        return keys, starts.astype(np.int32), starts.astype(np.int32)
    first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (starts[1:] > starts[:-1] + 1)))
    last = np.append(first[1:], len(keys)) - 1
    return keys[first], starts[first].astype(np.int32), (starts[last] - starts[first] + 1).astype(np.int32)


def _later_windows(block: pa.Table, length: int) -> pa.RecordBatch:
    """Windows of a block of whole subtrees that start earlier elsewhere."""
    order, depth = _tree(block["suffix"].to_pylist(), length)
    block = block.take(pa.array(order))
    left = block["left"].to_pylist()
    before = np.fromiter((len(x) // 8 for x in left), dtype=np.int64, count=len(left))
    reverse = reverse_left(left, 8, int(before.max(initial=0)))
    keys, starts = block["key"].to_numpy(), block["start"].to_numpy().astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = [(keys[:0], starts[:0])]
    for a, active, equal, _ in interval_windows(depth, reverse, before, block["windows"].to_numpy(), length):
        key, start = keys[active], starts[active] + before[active] - a
        rank = np.lexsort((start, key, equal))
        later = rank[1:][equal[rank][1:] == equal[rank][:-1]]
        found.append((key[later], start[later]))
    marks = run_marks(*(np.concatenate(x) for x in zip(*found)))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in marks], ["key", "start", "windows"])


def _subtrees(batches: Iterator[pa.RecordBatch], length: int, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted by prefix: whole subtrees are gathered until a block is full."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < block_rows:
            continue
        table = pa.Table.from_batches(held)
        prefix = table["prefix"].to_numpy()
        cut = int(np.searchsorted(prefix, prefix[-1]))
        if cut:
            yield _later_windows(table.slice(0, cut), length)
            table = table.slice(cut)
        held, rows = table.to_batches(), table.num_rows
    if rows:
        yield _later_windows(pa.Table.from_batches(held), length)


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every window as a suffix of its own, with all its words as the prefix."""
    for batch in batches:
        rows: dict[str, list] = {"prefix": [], "check": [], "key": [], "start": []}
        for left, suffix, key, start, count in zip(*(batch[x].to_pylist() for x in ("left", "suffix", "key", "start", "windows"))):
            values = np.frombuffer(left + suffix, dtype=np.uint8)
            at = 8 * np.arange(count)
            hashes = range_hashes(values, at, at + 8 * length)
            firsts = np.frombuffer(left + suffix, dtype=np.uint64)[:count]
            rows["prefix"] += signed(hashes).tolist()
            rows["check"] += signed(mix(firsts)).tolist()
            rows["key"] += [key] * count
            rows["start"] += (start + np.arange(count)).tolist()
        yield pa.RecordBatch.from_pydict(
            rows, schema=pa.schema([("prefix", pa.int64()), ("check", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])
        )


def remove_repeated_words(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, crowd: int = CROWD, has_keys: bool = False
) -> DataFrame:
    """Columns key, doc_id, size, removed, spans, kept: see `kept.without`.

    A NULL or empty text keeps nothing and loses nothing; texts shorter than a
    passage are kept whole. Rows that repeat an id: see `documents.keyed`. Repeats
    inside one text and overlapping ones count. An empty table gives no rows.
    """
    docs = docs if has_keys else keyed(docs)
    settled = cut_lineage(settle(docs, "words", length, anchor, keep_first=True))
    prefix = F.xxhash64(F.substring("suffix", 1, 8 * anchor))
    parts = cut_lineage(contents(docs, settled, "words", length, anchor).withColumn("prefix", prefix))
    crowded = cut_lineage(parts.groupBy("prefix").count().where(F.col("count") > crowd).select("prefix"))
    fitting = parts
    marks = settled.where("repeated").select("key", "start", "windows")
    if not crowded.isEmpty():
        fitting = parts.join(crowded, "prefix", "left_anti")
        single = parts.join(crowded, "prefix", "left_semi").drop("prefix").mapInArrow(
            partial(_windows, length=length), "prefix long, check long, key long, start int"
        )
        single = cut_lineage(single)
        first = single.groupBy("prefix", "check").agg(F.min(F.struct("key", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
        later = single.join(first.where("n > 1"), ["prefix", "check"]).where(F.struct("key", "start") != F.col("first"))
        marks = marks.union(later.select("key", "start", F.lit(1).alias("windows")))
    trees = (
        fitting.repartition("prefix")
        .sortWithinPartitions("prefix")
        .select("prefix", "key", "start", "windows", "left", "suffix")
        .mapInArrow(partial(_subtrees, length=length, block_rows=crowd), MARKS)
    )
    return without(docs, marks.union(trees), "words", length)
