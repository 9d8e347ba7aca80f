"""Documents packed into sequences of equal size by multiway differencing.

Documents are cut where that helps, gathered into groups of many sequences, and each
group is partitioned by the method of Karmarkar and Karp: every piece starts as a
partition of its own, and the two partitions with the widest spread are merged, the
largest part of one with the smallest of the other, until one is left. Its parts
are the sequences, of almost equal length. Where one is longer than the capacity,
the group is partitioned again into one sequence more.

Groups are formed within a task from its rows in their order; nothing is shuffled.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import text_ids

CAPACITY = 4096
#: Sequences of a full group, the longest piece, and ids per sequence that a group leaves free.
GROUP = 256
PIECE = 512
SLACK = 8


def differencing(sizes: np.ndarray, parts: int) -> tuple[np.ndarray, list[list[int]]]:
    """Partition sizes into so many parts of nearly equal sums: the sums and the members of each."""
    children: list[tuple[int, int]] = []
    heap = []
    for item, size in enumerate(sizes.tolist()):
        sums = np.zeros(parts, dtype=np.int64)
        nodes = np.full(parts, -1, dtype=np.int64)
        sums[0], nodes[0] = size, item
        heap.append((-size, item, sums, nodes))
    heapq.heapify(heap)
    made, turn = len(sizes), itertools.count(len(sizes))
    while len(heap) > 1:
        _, _, sums, nodes = heapq.heappop(heap)
        _, _, other_sums, other_nodes = heapq.heappop(heap)
        other_nodes = other_nodes[::-1]
        both = (nodes >= 0) & (other_nodes >= 0)
        joined = np.where(nodes >= 0, nodes, other_nodes)
        joined[both] = made + np.arange(int(both.sum()))
        children += zip(nodes[both].tolist(), other_nodes[both].tolist())
        made += int(both.sum())
        sums = sums + other_sums[::-1]
        order = np.argsort(-sums, kind="stable")
        sums, joined = sums[order], joined[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), next(turn), sums, joined))
    if not heap:
        return np.zeros(parts, dtype=np.int64), [[] for _ in range(parts)]
    _, _, sums, nodes = heap[0]
    members = []
    for node in nodes.tolist():
        found, open_nodes = [], [node] if node >= 0 else []
        while open_nodes:
            n = open_nodes.pop()
            if n < len(sizes):
                found.append(n)
            else:
                open_nodes += children[n - len(sizes)]
        members.append(found)
    return sums, members


def windows(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Members of each sequence; as few sequences as keep all within capacity."""
    parts = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        sums, members = differencing(sizes, parts)
        if sums.max(initial=0) <= capacity:
            return [x for x in members if x]
        parts += 1


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.list_(pa.int32()))]
)


class _Packer:
    """Pieces of the current group, and the number of the next sequence."""

    def __init__(self, capacity: int, group: int, with_ids: bool):
        self.capacity, self.with_ids = capacity, with_ids
        self.room = self.full = group * (capacity - min(SLACK, capacity // 100))
        self.pieces: list[tuple[int | None, int, np.ndarray, int]] = []
        self.sequence = TaskContext.get().partitionId() << 36

    def add(self, doc_id: int | None, ids: np.ndarray, longest: int) -> Iterator[pa.RecordBatch]:
        start = 0
        while start < len(ids):
            size = min(longest, self.room, len(ids) - start)
            self.pieces.append((doc_id, start, ids[start : start + size], len(ids)))
            start += size
            self.room -= size
            if not self.room:
                yield self.close()

    def close(self) -> pa.RecordBatch:
        out: dict[str, list] = {name: [] for name in _ARROW.names}
        for members in windows(np.array([len(x[2]) for x in self.pieces], dtype=np.int64), self.capacity):
            offset = 0
            for doc_id, start, ids, total in (self.pieces[i] for i in members):
                row = (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")), total, self.sequence, offset)
                for name, value in zip(out, (*row, ids.astype(np.int32) if self.with_ids else None)):
                    out[name].append(value)
                offset += len(ids)
            self.sequence += 1
        self.pieces, self.room = [], self.full
        return pa.RecordBatch.from_pydict(out, schema=_ARROW)


def _packed(
    batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int, group: int, longest: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    packer = _Packer(capacity, group, with_ids)
    for batch in batches:
        keys = batch["doc_id"].to_pylist()
        for first, ids, offsets in text_ids(batch["text"], tokenizer, end_id):
            for row in range(len(offsets) - 1):
                yield from packer.add(keys[first + row], ids[offsets[row] : offsets[row + 1]].copy(), longest)
    if packer.pieces:
        yield packer.close()


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = CAPACITY,
    group: int = GROUP,
    longest: int = PIECE,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence, one row for each.

    Columns doc_id, start (the document's ids before the piece), length, ids_crc32,
    doc_tokens, sequence_id, offset and ids (NULL unless asked for). Each document
    is its ids and then `end_id`; a NULL or empty text is `end_id` alone. Every row
    is packed, whether or not its id is repeated or NULL. No rows give no pieces.
    """
    work = partial(
        _packed, tokenizer=tokenizer, end_id=end_id, capacity=capacity, group=group, longest=longest, with_ids=with_ids
    )
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(work, PIECES)
