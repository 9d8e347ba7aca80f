"""Exact similarity join of shingle sets by skipping in index lists and along set relations.

Whole sets are indexed by neighbours in the order of their tokens, the rarest first and
only as many as a partner must share two of. Index lists are kept by position in blocks: an entry
bounds how much its set can still share, and blocks whose bounds cannot meet are
skipped whole. Where a list is crowded, its sets are mostly relatives of each other:
they are not compared in pairs but each with one centre of the list, and then
answered from how they differ from it. With D the tokens in which a set differs from
the centre, two sets share as much as sizes and the overlap of their Ds say. All sets
close to the centre are linked to it at once; any other needs a partner with a common
difference, so the same index is built once more over the (small) Ds, ordered
by how frequent a difference is around its centre, where the common stock of the
relatives no longer occurs. That repeats for lists that are crowded again.

Nothing is lost on the way: every pair that can be linked meets in a list, and every
list is either compared or answered through a centre. After `DEPTH` rounds crowded
lists are compared in blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, scratch_path, shuffles_dropped
from .components import connected
from .documents import keyed, plain_ids
from .shingles import shingle_sets
from .textscan import chunks, lower_ascii, mix, signed, words

SHINGLE = 5
PERCENT = 80
#: Longest list whose members are compared with each other.
CROWD = 64
#: Rounds of centres before crowded lists are compared in blocks.
DEPTH = 4
#: Members compared beside one copy of their centre.
STAR = 500
#: Entries per block of an index list.
BLOCK = 8
#: Counters of the token frequencies, and in how many slices they travel. Fixed, whatever the corpus.
COUNTERS, SLICES = 1 << 20, 32
#: Occurrences from which a token can be hot, and tasks over which its entries are dealt.
HOT, SALTS = 4096, 64
#: Tokens handled at once by array operations.
PIECE = 1 << 20

SEQUENCES = "key long, doc_id long, high long, low long"
SETS = "key long, size long, tokens binary"
#: Slices of a task's counts, and rows with the size of a set.
COUNTED = "slice int, counts binary, key long, size long"
ROWS = f"space long, {SETS}"
PLACES = "space long, token long, key long, place long, size long, hot boolean"
ENTRIES = "space long, token long, key long, place long, size long, need long, cap long, outer boolean, hot boolean"
#: Pairs that met, or the members of a crowded list.
MEETINGS = f"{ENTRIES}, centre long, weight long"


def _sequences(batches: Iterator[pa.RecordBatch], fold_case: bool) -> Iterator[pa.RecordBatch]:
    """Two hashes of each document's sequence of words; zero and zero where there are none."""
    for batch in batches:
        for chunk in chunks(batch["text"]):
            found = words(lower_ascii(chunk.data) if fold_case else chunk.data, chunk.offsets)
            place = np.arange(len(found.hashes)) - found.offsets[found.row_of]
            hashes = []
            for seed in (1, 2):
                each = mix(found.hashes ^ mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(seed)))
                total = np.append(np.uint64(0), np.cumsum(each, dtype=np.uint64))
                hashes.append(pa.array(signed(total[found.offsets[1:]] - total[found.offsets[:-1]])))
            part = slice(chunk.first, chunk.first + chunk.rows)
            yield pa.RecordBatch.from_arrays([batch["key"][part], batch["doc_id"][part], *hashes], ["key", "doc_id", "high", "low"])


def _sets(batches: Iterator[pa.RecordBatch], length: int, fold_case: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch["text"]):
            values, offsets = shingle_sets(chunk.data, chunk.offsets, length, fold_case)
            keys = batch["key"].slice(chunk.first, chunk.rows)
            yield _row_batch(None, keys, np.diff(offsets), values, offsets)


def _formed(batches: Iterator[pa.RecordBatch], length: int, fold_case: bool) -> Iterator[pa.RecordBatch]:
    """Size and tokens of the set in place of the text, the last column; rows of one key that follow each other share them."""
    for batch in batches:
        key = batch["key"].to_numpy()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
        text = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        for chunk in chunks(batch["text"].take(pa.array(first))):
            values, offsets = shingle_sets(chunk.data, chunk.offsets, length, fold_case)
            sizes = np.diff(offsets)
            tokens = _row_batch(None, pa.nulls(len(sizes)), sizes, values, offsets)["tokens"]
            row, upto = np.searchsorted(text, [chunk.first, chunk.first + chunk.rows])
            own = text[row:upto] - chunk.first
            ends = np.append(0, np.cumsum(sizes[own]))
            first_row, at = int(row), 0
            while at < len(own):
                last = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE, side="right")) - 1)
                columns = [c[first_row + at : first_row + last] for c in batch.columns[:-1]]
                made = [pa.array(sizes[own[at:last]], pa.int64()), tokens.take(pa.array(own[at:last]))]
                yield pa.RecordBatch.from_arrays([*columns, *made], [*batch.schema.names[:-1], "size", "tokens"])
                at = last


def _chained(batches: Iterator[pa.RecordBatch], form: Callable, then: Callable) -> Iterator[pa.RecordBatch]:
    return then(form(batches))


@dataclass(frozen=True)
class StoredTexts:
    """Rows key and text stored by key, whose sets are formed again wherever they are read.

    A set is some 8 bytes a word that do not compress, several times its text.
    """

    rows: DataFrame
    length: int
    fold_case: bool

    def formed(self, rows: DataFrame) -> DataFrame:
        """Rows with the set's size and tokens in place of their text."""
        kept = rows.drop("text")
        form = partial(_formed, length=self.length, fold_case=self.fold_case)
        made = [T.StructField("size", T.LongType()), T.StructField("tokens", T.BinaryType())]
        return rows.select(*kept.columns, "text").mapInArrow(form, T.StructType([*kept.schema.fields, *made]))

    def over_sets(self, then: Callable, schema: str) -> DataFrame:
        """A function of batches over all sets in one space, run by the worker that forms them."""
        form = partial(_formed, length=self.length, fold_case=self.fold_case)
        rows = self.rows.select("key", F.lit(0).cast("long").alias("space"), "text")
        return rows.mapInArrow(partial(_chained, form=form, then=then), schema)

    @cached_property
    def counted(self) -> DataFrame:
        """Counts of the neighbours and sizes of the sets, formed once for both."""
        return cut_lineage(self.over_sets(partial(_counted, whole=True, sizes=True), COUNTED))

    @property
    def sizes(self) -> DataFrame:
        return self.counted.where("slice IS NULL").select("key", "size")


def _row_batch(space, keys, sizes, values: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    raw = pa.py_buffer(np.ascontiguousarray(values, dtype=np.uint64).tobytes())
    tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 8).astype(np.int64).tobytes()), raw])
    columns = [keys, pa.array(sizes, pa.int64()), tokens.cast(pa.binary())]
    if space is None:
        return pa.RecordBatch.from_arrays(columns, ["key", "size", "tokens"])
    return pa.RecordBatch.from_arrays([space, *columns], ["space", "key", "size", "tokens"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of batches of about `PIECE` tokens, with all their tokens and where each row's begin."""
    for batch in batches:
        column = batch["tokens"].cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data, first = column.buffers()[2] or b"", 0
        while first < len(column):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + 8 * PIECE, side="right")) - 1)
            values = np.frombuffer(data, dtype=np.uint8)[bounds[first] : bounds[last]].view(np.uint64)
            yield batch.slice(first, last - first), values, (bounds[first : last + 1] - bounds[first]) // 8
            first = last


def _counter(values: np.ndarray, space: np.ndarray) -> np.ndarray:
    return (mix(values ^ mix(space.astype(np.uint64))) >> np.uint64(64 - (COUNTERS.bit_length() - 1))).astype(np.int64)


def _neighbours(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every two tokens next to each other in a set's order; the first token has none before it.

    Chance brings single tokens together in ever more documents, but hardly two
    neighbours.
    """
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    before = np.append(np.uint64(0), values[:-1]) if len(values) else values
    before = np.where(np.arange(len(values)) == offsets[row], np.uint64(0), before)
    return row, mix(mix(before) * np.uint64(0x9E3779B97F4A7C15) + values)


def _counted(batches: Iterator[pa.RecordBatch], whole: bool, sizes: bool = False) -> Iterator[pa.RecordBatch]:
    """How often each counter's tokens occur in a task, in slices; counts end at 65,535, which only orders tokens.

    With `whole` the neighbours are counted, not the tokens; with `sizes` come the sizes of the sets as well.
    """
    names = _names(COUNTED)
    total = np.zeros(COUNTERS, dtype=np.int64)
    for batch, values, offsets in _pieces(batches):
        if whole:
            row, values = _neighbours(values, offsets)
        else:
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        space = batch["space"].to_numpy()[row]
        total += np.bincount(_counter(values, space), minlength=COUNTERS)
        if sizes:
            none = [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, batch["key"], batch["size"]], names)
    if total.any():
        parts = np.split(np.minimum(total, (1 << 16) - 1).astype(np.uint16), SLICES)
        none = [pa.nulls(SLICES, pa.int64())] * 2
        columns = [pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()), *none]
        yield pa.RecordBatch.from_arrays(columns, names)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the slices of all tasks, as the number of binary digits of each count."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, counts in zip(batch["slice"].to_pylist(), batch["counts"]):
            part = np.frombuffer(counts.as_buffer(), dtype=np.uint16).astype(np.float64)
            sums[number] = sums[number] + part if number in sums else part
    rows = [np.frexp(x)[1].astype(np.uint8).tobytes() for x in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(rows, pa.binary())], ["slice", "counts"])


def _order(counted: DataFrame) -> tuple[Broadcast, int]:
    """Class of frequency of every counter (a megabyte, whatever the number of rows), and the first class of hot tokens."""
    parts = counted.where("slice IS NOT NULL").select("slice", "counts")
    sums = cut_lineage(parts.repartition("slice").mapInArrow(_classes, "slice int, counts binary"))
    classes = np.zeros((SLICES, COUNTERS // SLICES), dtype=np.uint8)
    for number, counts in sums.collect():
        classes[number] = np.frombuffer(counts, dtype=np.uint8)
    mean = np.ldexp(1.0, classes.astype(np.int64)).mean()
    hot = int(np.frexp(max(HOT, HOT / 64 * mean))[1])
    return counted.sparkSession.sparkContext.broadcast(classes.reshape(-1)), hot


def _whole_entries(batches: Iterator[pa.RecordBatch], order: Broadcast, hot: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The indexed neighbours of whole sets, the rarest first.

    A token that only x has takes two of x's neighbours away, one that only y has takes
    one. For linked sets that is at most 2 (100 - percent) / 100 of the size of x, so
    that x shares two neighbours among its first ones of as many and two more, unless
    it has fewer than two left.
    """
    for batch, values, offsets in _pieces(batches):
        space, key, size = (batch[c].to_numpy() for c in ("space", "key", "size"))
        row, token = _neighbours(values, offsets)
        kind = order.value[_counter(token, space[row])]
        at = np.lexsort((token, kind, row))
        place = np.arange(len(row)) - offsets[row]
        first = place * 100 <= 2 * (100 - percent) * size[row] + 100
        row, place, at = row[first], place[first], at[first]
        columns = [space[row], signed(token[at]), key[row], place, size[row], kind[at] >= hot]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(PLACES))


def _entries(batches: Iterator[pa.RecordBatch], order: Broadcast, hot: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The indexed tokens of each set, with bounds for its partners.

    Sets x and y are linked when 2 (100 + percent) times the overlap of their Ds is at
    least need(x) + need(y). An entry's cap is the largest need that a partner may
    have whose first or second common token it is; linked sets meet in two entries,
    unless they need one common token only.
    """
    for batch, values, offsets in _pieces(batches):
        space, size, need, least = (batch[c].to_numpy() for c in ("space", "size", "need", "least"))
        count = np.diff(offsets)
        row = np.repeat(np.arange(len(count)), count)
        kind = order.value[_counter(values, space[row])]
        at = np.lexsort((values, kind, row))
        place = np.arange(len(row)) - offsets[row]
        cap = 2 * (100 + percent) * (count[row] - place + 1) - need[row]
        useful = cap >= least[row]
        row, place, cap, at = row[useful], place[useful], cap[useful], at[useful]
        outer = batch["outer"].to_numpy(zero_copy_only=False)
        columns = [space[row], signed(values[at]), batch["key"].to_numpy()[row], place, size[row], need[row], cap, outer[row], kind[at] >= hot]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(ENTRIES))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _meeting(
    lists: np.ndarray, key: np.ndarray, size: np.ndarray, need: np.ndarray, cap: np.ndarray, outer: np.ndarray, percent: int, whole: bool
) -> np.ndarray:
    """Pairs whose sizes and bounds admit each other, in blocks of entries; `lists` numbers the lists, each in order of position.

    Columns list, smaller key, larger key, weight; a weight of two, from one list or
    several, makes a candidate. It is two at once for sets that need to have one
    entry in common only.
    """
    starts = np.flatnonzero(np.append(True, lists[1:] != lists[:-1])) if len(lists) else np.zeros(0, dtype=np.int64)
    lengths = np.diff(np.append(starts, len(lists)))
    blocks = -(-lengths // BLOCK)
    of = np.repeat(np.arange(len(lengths)), blocks)
    number = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    member = starts[of][:, None] + number[:, None] * BLOCK + np.arange(BLOCK)
    there = member < (starts + lengths)[of][:, None]
    member = np.where(there, member, 0)
    high = np.where(there, cap[member], np.iinfo(np.int64).min).max(axis=1)
    low = np.where(there, need[member], np.iinfo(np.int64).max).min(axis=1)
    found = [np.zeros((4, 0), dtype=np.int64)]
    for shift in range(int(blocks.max(initial=0))):
        left = np.arange(len(of) - shift)
        right = left + shift
        left = left[(of[left] == of[right]) & (high[left] >= low[right]) & (high[right] >= low[left])]
        for first in range(0, len(left), 1 << 14):
            x = left[first : first + (1 << 14)]
            y = x + shift
            a, b = member[x][:, :, None], member[y][:, None, :]
            fits = there[x][:, :, None] & there[y][:, None, :] & (cap[a] >= need[b]) & (cap[b] >= need[a]) & (outer[a] | outer[b])
            fits &= (a < b) & (key[a] != key[b])
            fits &= np.minimum(size[a], size[b]) * 100 >= np.maximum(size[a], size[b]) * percent
            which, i, j = np.nonzero(fits)
            a, b = member[x][which, i], member[y][which, j]
            if whole:
                once = (2 * percent - 100) * np.minimum(size[a], size[b]) < 200
            else:
                once = need[a] + need[b] <= 2 * (100 + percent)
            weight = 1 + once
            found.append(np.array([lists[a], np.minimum(key[a], key[b]), np.maximum(key[a], key[b]), weight]))
    return np.concatenate(found, axis=1)


def _lists(batches: Iterator[pa.RecordBatch], crowd: int | None, percent: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by list and position: pairs of the small lists, and the members of crowded ones as they come.

    Of a list that goes on in the next batch at most `crowd` rows are held. With
    `crowd=None` every list is compared.
    """
    schema = pa.schema([(n, pa.bool_() if n in ("outer", "hot") else pa.int64()) for n in _names(MEETINGS)])
    names = _names(ENTRIES)
    held, crowded = None, None  # rows of the last list; the last list, if crowded

    def handled(rows: pa.RecordBatch, closed: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, crowded
        columns = {n: rows[n].to_numpy(zero_copy_only=False) for n in names}
        fresh = np.append(True, (np.diff(columns["space"]) != 0) | (np.diff(columns["token"]) != 0))
        lists = np.cumsum(fresh) - 1
        sizes = np.bincount(lists)
        many = np.zeros(len(sizes), dtype=bool) if crowd is None else sizes > crowd
        first = (columns["space"][0], columns["token"][0])
        many[0] |= crowded == first
        full = many[lists] | (columns["hot"] & (crowd is not None))
        last = lists == len(sizes) - 1
        crowded = (columns["space"][-1], columns["token"][-1]) if many[-1] else None
        waits = np.zeros(len(lists), dtype=bool) if closed else last & ~full
        held = rows.filter(pa.array(waits)) if waits.any() else None
        if full.any():
            passed = rows.filter(pa.array(full))
            none = pa.nulls(passed.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*passed.columns, none, none], schema=schema)
        small = np.flatnonzero(~full & ~waits)
        own = [columns[n][small] for n in ("key", "size", "need", "cap", "outer")]
        lists = lists[small]
        owner, a, b, weight = _meeting(lists, *own, percent, whole)
        space = columns["space"][small][np.searchsorted(lists, owner)]
        pairs, which = np.unique(np.array([space, a, b]), axis=1, return_inverse=True)
        total = np.bincount(which.reshape(-1), weight, minlength=pairs.shape[1]).astype(np.int64)
        if len(total):
            rest = {"space": pairs[0], "centre": pairs[1], "key": pairs[2], "weight": total}
            yield pa.RecordBatch.from_arrays(
                [pa.array(rest[f.name]) if f.name in rest else pa.nulls(len(total), f.type) for f in schema], schema=schema
            )

    for batch in batches:
        if batch.num_rows:
            batch = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            yield from handled(batch, False)
    if held is not None:
        yield from handled(held, True)


def _by_key(rows: DataFrame) -> DataFrame:
    """Rows stored in buckets of their key: joins on it move the other side only.

    The frame comes from a join on the key, so its tasks write whole buckets.
    """
    spark = rows.sparkSession
    name, buckets = f"sets_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.format("parquet").bucketBy(buckets, "key").option("path", scratch_path(spark, "sets"))
    if "text" in rows.columns:
        writer = writer.option("compression", "zstd")
    with shuffles_dropped(spark):
        writer.saveAsTable(name)
    return spark.table(name)


def _beside(rows: DataFrame | StoredTexts, edges: DataFrame) -> DataFrame:
    """Both ends of edges (space, centre, key) with their tokens, each centre before its keys; large stars in several tasks."""
    shares = edges.groupBy("space", "centre").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("shares"))
    share = F.pmod(F.xxhash64("key"), F.col("shares")).alias("share")
    own = edges.join(shares, ["space", "centre"]).select("space", "centre", "key", share)
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share")
    heads = shares.select("space", "centre", F.col("centre").alias("key"), turns)
    ends = own.union(heads)
    if isinstance(rows, StoredTexts):
        joined = rows.formed(ends.join(rows.rows, "key"))
    else:
        # In the first round there is one space, and the rows are stored by their key.
        place = ["space", "key"] if "space" in rows.columns else ["key"]
        joined = ends.join(rows.select(*place, "size", "tokens"), place)
    return (
        joined.repartition("space", "centre", "share")
        .sortWithinPartitions("space", "centre", "share", F.col("key") != F.col("centre"), "key")
        .select("space", "centre", "key", "size", "tokens")
    )


def _with_centres(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each row that is not a centre, with its centre's row: centre, key, sizes, tokens."""
    head = None
    for batch in batches:
        columns = (batch[c].to_numpy() for c in ("space", "centre", "key", "size"))
        for space, centre, key, size, raw in zip(*columns, batch["tokens"]):
            tokens = np.frombuffer(raw.as_buffer(), dtype=np.uint64)
            if centre == key:
                head = (space, centre, size, tokens.copy())
            if head is not None and head[:2] == (space, centre):
                yield centre, key, head[2], size, head[3], tokens


def _need(different: int, size: int, percent: int) -> int:
    return (100 + percent) * different - (100 - percent) * size


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common members of two sorted arrays without repeats."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    out: tuple[list, list] = ([], [])
    for centre, key, size, own, tokens, others in _with_centres(batches):
        least = _need(len(tokens), size, percent) + _need(len(others), own, percent)
        if centre != key and 2 * (100 + percent) * shared(tokens, others) >= least:
            out[0].append(centre)
            out[1].append(key)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a new space: the tokens that a set or its centre has alone."""
    waiting: list = []

    def rows() -> pa.RecordBatch:
        offsets = np.append(0, np.cumsum([len(x[3]) for x in waiting]))
        columns = [pa.array([x[i] for x in waiting], pa.int64()) for i in range(3)]
        return _row_batch(columns[0], columns[1], columns[2], np.concatenate([x[3] for x in waiting]), offsets)

    held = 0
    for centre, key, _, own, tokens, others in _with_centres(batches):
        waiting.append((centre, key, own, np.setxor1d(tokens, others, assume_unique=True)))
        held += len(waiting[-1][3])
        if held > PIECE:
            yield rows()
            waiting, held = [], 0
    if waiting:
        yield rows()


def _bounded(rows: DataFrame, percent: int, placed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with need, least (the lowest need that a partner can have) and outer, and the links to the centres.

    Around a centre the sets whose need and the lowest one together are not above
    zero are linked with the one that has the lowest; of the others (outer) each
    pair needs a common token, and so does each with one of the linked sets. With
    `placed` (key, component: what is connected already) the sets of the lowest one's
    component are not outer either, as they need no further link to it.
    """
    different = (F.octet_length("tokens") / 8).cast("long")
    rows = rows.withColumn("need", different * (100 + percent) - F.col("size") * (100 - percent))
    rows = rows.withColumn("component", F.lit(None).cast("long")) if placed is None else rows.join(placed, "key")
    lowest = rows.groupBy("space").agg(F.min(F.struct("need", "key", "component")).alias("low"))
    rows = rows.join(lowest, "space").withColumn("outer", F.col("need") > -F.col("low.need"))
    links = rows.where(~F.col("outer")).select(F.col("key").alias("a"), F.col("low.key").alias("b")).where("a <> b")
    if placed is not None:
        rows = rows.withColumn("outer", F.col("outer") & (F.col("component") != F.col("low.component")))
    nearest = rows.where("outer").groupBy("space").agg(F.min("need").alias("least_outer"))
    least = F.when(F.col("outer"), F.col("low.need")).otherwise(F.col("least_outer"))
    return rows.join(nearest, "space").select("space", "key", "size", "tokens", "need", least.alias("least"), "outer"), links


def _met(entries: DataFrame, crowd: int | None, percent: int, whole: bool) -> DataFrame:
    """What comes of the index lists, in one exchange of the entries; hot tokens go to many tasks."""
    dealt = entries.withColumn("salt", F.lit(0))
    if crowd is not None:
        dealt = entries.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(SALTS))).otherwise(F.lit(0)))
    dealt = dealt.repartition("space", "token", "salt").sortWithinPartitions("space", "token", "place", "key")
    if whole:
        # Before the first common neighbour lie at most 3 (100 - percent) / (100 + percent) of both sizes together.
        need = (F.col("place") - 1) * (100 + percent) - F.col("size") * (3 * (100 - percent))
        dealt = dealt.select("*", need.alias("need"), (-need).alias("cap"), F.lit(True).alias("outer"))
    lists = partial(_lists, crowd=crowd, percent=percent, whole=whole)
    return cut_lineage(dealt.select(*_names(ENTRIES)).mapInArrow(lists, MEETINGS))


def _compared(met: DataFrame, rows: DataFrame | StoredTexts, percent: int) -> DataFrame:
    """Links among the pairs that met often enough."""
    pairs = met.where("weight IS NOT NULL").groupBy("space", "centre", "key").agg(F.sum("weight").alias("weight"))
    pairs = cut_lineage(pairs.where("weight > 1").select("space", "centre", "key"))
    return cut_lineage(_beside(rows, pairs).mapInArrow(partial(_linked, percent=percent), "a long, b long"))


def _in_blocks(members: DataFrame, crowd: int) -> DataFrame:
    """Crowded lists once for each two blocks of their members, each pair of blocks under a token of its own."""
    sizes = members.groupBy("space", "token").agg(F.ceil(F.count(F.lit(1)) / crowd).alias("blocks"))
    dealt = members.join(sizes, ["space", "token"]).withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    token = F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.withColumn("token", token).select(*_names(ENTRIES))


def _centred(entries: DataFrame, rows: DataFrame | StoredTexts, percent: int) -> DataFrame:
    """Rows of the spaces around the centres of crowded lists (one member alone has no partner).

    Linked sets lie in one class of sizes or in two adjacent ones, so a set goes to
    the centres of its class and of the one below.
    """
    kind = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9)
    dealt = entries.withColumn("kind", F.explode(F.array(kind, kind - 1)))
    of_list = ["space", "token", "kind"]
    centres = dealt.groupBy(*of_list).agg(
        # The same few sets are the centres of all lists of their relatives.
        F.min("key").alias("middle"),
        F.min("need").alias("low"),
        F.max("cap").alias("high"),
        (F.max("outer") & (F.count(F.lit(1)) > 1)).alias("some"),
    )
    # Members whose bounds admit no other one have no partner here.
    dealt = dealt.join(centres.where("some"), of_list).where("cap >= low AND need <= high")
    edges = dealt.select("space", F.col("middle").alias("centre"), "key")
    # What sets two sets apart is the same wherever they met.
    edges = cut_lineage(edges.groupBy("centre", "key").agg(F.min("space").alias("space")).select("space", "centre", "key"))
    found = _beside(rows, edges.where("key <> centre")).mapInArrow(_differences, ROWS)
    return cut_lineage(found.groupBy("space", "key").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens")))


def _round(
    rows: DataFrame | StoredTexts, percent: int, crowd: int, depth: int, last: int, placed: DataFrame | None = None
) -> tuple[list[DataFrame], DataFrame | None]:
    """Links found in one round, and the rows of the next one if lists are crowded."""
    found = []
    if depth == 0:
        order, hot = _order(rows.counted)
        entries = rows.over_sets(partial(_whole_entries, order=order, hot=hot, percent=percent), PLACES)
    else:
        bounded, links = _bounded(rows, percent, placed)
        found.append(cut_lineage(links))
        order, hot = _order(rows.select("space", "tokens").mapInArrow(partial(_counted, whole=False), COUNTED))
        entries = bounded.mapInArrow(partial(_entries, order=order, hot=hot, percent=percent), ENTRIES)
    met = _met(entries, crowd, percent, depth == 0)
    found.append(_compared(met, rows, percent))
    members = met.where("weight IS NULL")
    if members.isEmpty():
        return found, None
    if depth == last:
        pairs = _met(_in_blocks(members, crowd), None, percent, False)
        # A pair may meet once here and once in a small list.
        found.append(_compared(pairs.withColumn("weight", pairs["weight"] * 2), rows, percent))
        return found, None
    return found, _centred(members, rows, percent)


def stored_sets(texts: DataFrame, length: int, fold_case: bool) -> DataFrame:
    """Rows key, size, tokens of keyed texts, stored by key; they come from a join on the key."""
    return _by_key(texts.select("key", "text").mapInArrow(partial(_sets, length=length, fold_case=fold_case), SETS))


def compared_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs centre, key of stored sets those that are linked, as a, b."""
    edges = cut_lineage(pairs.distinct().select(F.lit(0).cast("long").alias("space"), "centre", "key"))
    return cut_lineage(_beside(sets, edges).mapInArrow(partial(_linked, percent=percent), "a long, b long"))


def around_centres(
    stars: DataFrame, sets: DataFrame, placed: DataFrame, percent: int, crowd: int = CROWD, depth: int = DEPTH
) -> list[DataFrame]:
    """Links among stored sets that have a centre in common (rows centre, key), as tables a, b.

    They follow from the tokens in which the sets differ from the centre. `placed` (key,
    component) says what is connected already; links that connect more are all found.
    """
    edges = stars.where("key <> centre").select(F.lit(0).cast("long").alias("space"), "centre", "key")
    found = _beside(sets, edges).mapInArrow(_differences, ROWS)
    space = cut_lineage(found.groupBy("space", "key").agg(F.first("size").alias("size"), F.first("tokens").alias("tokens")))
    links: list[DataFrame] = []
    if space.isEmpty():
        return links
    for turn in range(1, depth + 1):
        of_turn, space = _round(space, percent, crowd, turn, depth, placed)
        links += of_turn
        if space is None:
            break
    return links


def similar_sets(
    docs: DataFrame,
    length: int = SHINGLE,
    percent: int = PERCENT,
    fold_case: bool = True,
    crowd: int = CROWD,
    depth: int = DEPTH,
    has_keys: bool = False,
) -> DataFrame:
    """Rows key, doc_id, n_shingles, component_id, n_links: one for each document.

    Documents whose sets of distinct runs of `length` words have a Jaccard similarity
    of `percent` hundredths or more (above 50) are linked. component_id is the smallest id that
    links reach. n_links counts the links that were used to connect the set (equal
    texts are one set; a set may have more links to sets that it is already
    connected with).

    A text with fewer words than a shingle has its whole sequence as one. Texts that
    are NULL, empty or without words have no set and no links. Rows that repeat an id:
    see `documents.keyed`; without an id component_id may be NULL. Ties in the choice
    of a centre go to the smaller key and have no effect on the result. An empty table
    gives no rows. Words and shingles are compared by 64-bit hashes.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent has to be above 50 and at most 100")
    docs = docs if has_keys else keyed(docs)
    sequences = cut_lineage(docs.select("key", "doc_id", "text").mapInArrow(partial(_sequences, fold_case=fold_case), SEQUENCES))
    chosen = cut_lineage(sequences.groupBy("high", "low").agg(F.min("key").alias("key")))
    texts = docs.select("key", "text").join(chosen.select("key"), "key")
    stored = StoredTexts(_by_key(texts), length, fold_case)
    links, space = [], stored
    for turn in range(depth + 1):
        found, space = _round(space, percent, crowd, turn, depth)
        links += found
        if space is None:
            break
    every = cut_lineage(reduce(DataFrame.union, links).distinct())
    ends = every.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n_links"))
    placed = connected(every).select(F.col("node").alias("key"), "component")
    placed = stored.sizes.join(placed, "key", "left").join(ends, "key", "left")
    placed = placed.select(
        F.col("key").alias("chosen"), "size", F.coalesce("component", "key").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    placed = chosen.withColumnRenamed("key", "chosen").join(placed, "chosen").drop("chosen")
    # Texts without words share a sequence but are not linked.
    own = F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("key")).alias("component")
    result = sequences.join(placed, ["high", "low"]).select("key", "doc_id", F.col("size").alias("n_shingles"), own, "n_links")
    if plain_ids(docs):
        return result.withColumnRenamed("component", "component_id")
    result = cut_lineage(result)
    names = result.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return result.join(names, "component").select("key", "doc_id", "n_shingles", "component_id", "n_links")
