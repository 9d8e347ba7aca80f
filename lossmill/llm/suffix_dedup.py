"""Repeated byte strings, by a distributed sort of suffixes.

Every byte is removed that lies in a string of `length` bytes which also starts
anywhere else. Suffixes begin at the units' anchors (see `units`), one for each
different unit that shares its anchor. They are sorted by merging: each task sorts
its suffixes into a run and cuts it at the bounds of the target ranges; pieces are
exchanged front-coded, as the length of the prefix shared with the suffix before
and the rest; each range merges its pieces with a tournament of losers that keeps
for every candidate how far it agrees with the last winner and compares from there
on only. The merge yields the common prefixes of neighbours, and intervals of
suffixes that agree far enough, with equal bytes before the anchor, are repeats.

Ties in the suffix are ordered by the bytes before it, so that a crowd of equal
suffixes can be cut as well. An interval that touches the end of its range may go
on in the next one: its windows are compared across ranges by their hashes.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
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
from .substring_dedup import run_marks
from .textscan import range_hashes, signed

LENGTH = 200
ANCHOR = 64
#: Suffixes that make a range of their own worthwhile; there are at most two ranges per shuffle partition.
RANGE_ROWS = 4000

#: Above every byte of UTF-8: parts the suffix from the bytes that stand before it.
END = b"\xff"
_BLOCK = pa.schema(
    [
        ("range", pa.int32()),
        ("shared", pa.list_(pa.int32())),
        ("rest", pa.list_(pa.binary())),
        ("size", pa.list_(pa.int32())),
        ("key", pa.list_(pa.int64())),
        ("start", pa.list_(pa.int32())),
        ("windows", pa.list_(pa.int32())),
    ]
)
BLOCK = (
    "range int, shared array<int>, rest array<binary>, size array<int>, key array<bigint>, "
    "start array<int>, windows array<int>"
)
MARKS = "key long, start int, windows int, high long, low long"
_MARKS = pa.schema(
    [("key", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), ("high", pa.int64()), ("low", pa.int64())]
)


def agreement(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes need no look."""
    end = min(len(a), len(b))
    while known + 32 <= end and a[known : known + 32] == b[known : known + 32]:
        known += 32
    while known < end and a[known] == b[known]:
        known += 1
    return known


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings, the prefix shared with the one before, and the rest."""
    shared = [0, *map(agreement, strings[:-1], strings[1:])][: len(strings)]
    return shared, [x[n:] for x, n in zip(strings, shared)]


def decode_front(shared: list[int], rest: list[bytes]) -> list[bytes]:
    strings, last = [], b""
    for n, tail in zip(shared, rest):
        last = last[:n] + tail
        strings.append(last)
    return strings


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Merge sorted runs of strings with their shared prefixes: run, position, agreement with the last winner.

    Each run's head carries its agreement with the last string given out. Of two
    heads the one that agrees longer comes first, and only equal agreement makes
    a comparison necessary, which starts behind it.
    """
    width = 1
    while width < len(runs):
        width *= 2
    heads: list[bytes | None] = [run[0][0] if run[0] else None for run in runs] + [None] * (width - len(runs))
    agrees = [0] * width
    at = [0] * width
    losers = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs; the loser's agreement becomes that with the winner."""
        left, right = heads[a], heads[b]
        if right is None:
            return a, b
        if left is None:
            return b, a
        if agrees[a] != agrees[b]:
            return (a, b) if agrees[a] > agrees[b] else (b, a)
        n = agreement(left, right, agrees[a])
        if left[n:] <= right[n:]:
            agrees[b] = n
            return a, b
        agrees[a] = n
        return b, a

    def build(node: int) -> int:
        if node >= width:
            return node - width
        winner, losers[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if width > 1 else 0
    while heads[winner] is not None:
        yield winner, at[winner], agrees[winner]
        at[winner] += 1
        strings, shared = runs[winner]
        if at[winner] < len(strings):
            heads[winner], agrees[winner] = strings[at[winner]], shared[at[winner]]
        else:
            heads[winner] = None
        node = (winner + width) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def _runs(batches: Iterator[pa.RecordBatch], bounds: list[bytes], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, suffix = batch["left"].to_pylist(), batch["suffix"].to_pylist()
        strings = [s[:length] + END + p[::-1] for p, s in zip(left, suffix)]
        order = sorted(range(len(strings)), key=strings.__getitem__)
        keys, starts, counts = (batch[x].to_pylist() for x in ("key", "start", "windows"))
        target = [bisect_right(bounds, strings[i]) for i in order]
        rows: dict[str, list] = {name: [] for name in _BLOCK.names}
        first = 0
        while first < len(order):
            last = bisect_right(target, target[first])
            piece = order[first:last]
            shared, rest = front_code([strings[i] for i in piece])
            values = (target[first], shared, rest, [min(len(suffix[i]), length) for i in piece], [keys[i] for i in piece], [starts[i] for i in piece], [counts[i] for i in piece])
            for name, value in zip(rows, values):
                rows[name].append(value)
            first = last
        yield pa.RecordBatch.from_pydict(rows, schema=_BLOCK)


def _merged(blocks: pa.Table, length: int, bounds: list[bytes]) -> pa.Table:
    """Repeated windows of one range, and hashes of those that may have equals beyond it.

    An interval goes on beyond the range only if it agrees deep enough with the
    bound there. Of equal windows one stands for all; its key is NULL if the range
    has shown them to be repeated already.
    """
    target = blocks["range"][0].as_py()
    columns = {name: blocks[name].to_pylist() for name in _BLOCK.names[1:]}
    runs = [(decode_front(shared, rest), shared) for shared, rest in zip(columns["shared"], columns["rest"])]
    order, common = [], []
    for run, place, agrees in merge_runs(runs):
        order.append((run, place))
        common.append(agrees)
    size = np.array([columns["size"][r][i] for r, i in order], dtype=np.int64)
    keys = np.array([columns["key"][r][i] for r, i in order], dtype=np.int64)
    starts = np.array([columns["start"][r][i] for r, i in order], dtype=np.int64)
    windows = np.array([columns["windows"][r][i] for r, i in order], dtype=np.int64)
    texts = [runs[r][0][i] for r, i in order]
    depth = np.minimum(np.array(common, dtype=np.int64), size)
    depth[1:] = np.minimum(depth[1:], size[:-1])
    left = [x[n + 1 :][::-1] for x, n in zip(texts, size.tolist())]
    before = np.fromiter(map(len, left), dtype=np.int64, count=len(left))
    reverse = reverse_left(left, 1, int(before.max(initial=0)))
    # What lies below a bound does not begin with all of it.
    low_reach = min(agreement(bounds[target - 1], texts[0]), len(bounds[target - 1]) - 1) if target > 0 else 0
    high_reach = agreement(bounds[target], texts[-1]) if target < len(bounds) else 0
    found = [(keys[:0], starts[:0])]
    beyond: dict[str, list] = {name: [] for name in ("key", "start", "windows", "high", "low")}
    for a, active, equal, interval in interval_windows(depth, reverse, before, windows, length):
        _, first, inverse, count = np.unique(equal, return_index=True, return_inverse=True, return_counts=True)
        again = active[count[inverse] > 1]
        found.append((keys[again], starts[again] + before[again] - a))
        at = interval[active[first]]
        open_low = (at == interval[0]) & (low_reach >= length - a)
        open_high = (at == interval[-1]) & (high_reach >= length - a)
        for one, times in zip(active[first[open_low | open_high]].tolist(), count[open_low | open_high].tolist()):
            whole = np.frombuffer(left[one][len(left[one]) - a :] + texts[one][: length - a], dtype=np.uint8)
            row = (
                int(keys[one]) if times == 1 else None,
                int(starts[one] + before[one] - a),
                1,
                int(signed(range_hashes(whole, np.array([0]), np.array([length])))[0]),
                int(signed(range_hashes(whole[::-1], np.array([0]), np.array([length])))[0]),
            )
            for name, value in zip(beyond, row):
                beyond[name].append(value)
    marks = run_marks(*(np.concatenate(x) for x in zip(*found)))
    none = [None] * len(marks[0])
    decided = pa.table(dict(zip(beyond, (*marks, none, none))), schema=_MARKS)
    return pa.concat_tables([decided, pa.table(beyond, schema=_MARKS)])


def _bounds(parts: DataFrame, length: int, rows: int, ranges: int, anchor: int) -> list[bytes]:
    """Bounds of the ranges from a sample of a few dozen suffixes for each."""
    if rows <= 1 or ranges <= 1:
        return []
    wanted = 40 * ranges
    sample = parts.select("left", "suffix").sample(min(1.0, 1.5 * wanted / rows), seed=7).limit(2 * wanted).collect()
    strings = sorted(bytes(x["suffix"])[:length] + END + bytes(x["left"])[::-1] for x in sample)
    return spread_bounds(strings, ranges, anchor)


def spread_bounds(strings: list[bytes], ranges: int, anchor: int) -> list[bytes]:
    """Bounds that part sorted strings evenly, but the suffixes of one anchor only where they fill more than a range.

    A bound within an anchor leaves all its windows open (see `_merged`), each a row to be
    compared; before the anchor it leaves none.
    """
    found = set()
    for i in range(1, ranges) if strings else ():
        bound = strings[len(strings) * i // ranges]
        first = bisect_left(strings, bound[:anchor])
        same = bisect_right(strings, bound[:anchor], first, key=lambda x: x[:anchor]) - first
        found.add(bound[:anchor] if same * ranges <= len(strings) else bound)
    return sorted(found)


def remove_repeated_bytes(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, ranges: int | None = None
) -> DataFrame:
    """Columns key, doc_id, size, removed, spans, kept: see `kept.without`.

    `ranges`: parts of the suffix order, by default one for RANGE_ROWS suffixes, but
    at most twice the shuffle partitions.
    A NULL or empty text keeps nothing and loses nothing; texts of fewer bytes
    than a window are kept whole. Rows that repeat an id: see `documents.keyed`.
    An empty table gives no rows.
    """
    docs = keyed(docs)
    settled = cut_lineage(settle(docs, "bytes", length, anchor, keep_first=False))
    parts = cut_lineage(contents(docs, settled, "bytes", length, anchor))
    rows = parts.count()
    most = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(parts, length, rows, ranges or min(most, -(-rows // RANGE_ROWS)), anchor)
    pieces = parts.mapInArrow(partial(_runs, bounds=bounds, length=length), BLOCK)

    def merge(blocks: pa.Table) -> pa.Table:
        return _merged(blocks, length, bounds)

    merged = cut_lineage(pieces.groupBy("range").applyInArrow(merge, MARKS))
    decided = merged.where("high IS NULL").select("key", "start", "windows")
    beyond = merged.where("high IS NOT NULL")
    shared = beyond.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    across = beyond.where("key IS NOT NULL").join(shared, ["high", "low"], "left_semi").select("key", "start", "windows")
    marks = settled.where("repeated").select("key", "start", "windows").union(decided).union(across)
    return without(docs, marks, "bytes", length)
