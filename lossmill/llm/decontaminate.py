"""Benchmark passages in documents, by SimHash and exact weighted similarity.

A window of a document is as many words as an item has; a document of fewer words is
one window as a whole. Windows and items are
weighted multisets of five-word shingles; a shingle weighs the more the fewer items
have it. A window without any shingle of the benchmark has similarity zero with
every item and gets no fingerprint; all others do, at every position. Fingerprints
are found in an index of blocks: within `RADIUS` bits of each other, two
fingerprints agree in one of `BLOCKS` blocks up to RADIUS / BLOCKS bits, so looking
up each block's close values misses none. What is found within the radius is
compared exactly: shared weight against joint weight.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .documents import keyed
from .textscan import chunks, gram_hashes, lower_ascii, mix, words

SHINGLE = 5
SIMILARITY = 0.8
#: Bits by which fingerprints at the threshold may differ: about ten expected, with four deviations.
RADIUS = 22
BLOCKS = 8
#: Bytes of benchmark text that are searched for in one pass over the documents.
PASS_BYTES = 8_000_000

_BLOCK_BITS = 64 // BLOCKS


@dataclass
class Items:
    """Items of one number of words, which all have shingles of one size."""

    length: int
    shingle: int
    ids: list[int]
    counts: list[dict[int, int]]
    prints: np.ndarray
    known: np.ndarray
    #: For each block, value and item: whether the item's block is near enough.
    near: np.ndarray


def _fingerprint(sums: np.ndarray) -> np.ndarray:
    """64 bits from the signs of 64 sums."""
    return ((sums > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=-1, dtype=np.uint64)


def _votes(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What each shingle adds to each of 64 sums."""
    bits = (mix(shingles ^ np.uint64(0xA0761D6478BD642F))[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    return np.where(bits == 1, weights[:, None], -weights[:, None])


class Index:
    """The items of one pass and the weights of their shingles."""

    def __init__(self, rows: list[tuple[int, str]], weights: dict[int, int], rare: int):
        self.weights, self.rare = weights, rare
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in rows:
            hashes = _word_hashes(text)
            if len(hashes):
                by_length.setdefault(len(hashes), []).append((item, hashes))
        self.groups = [self._group(length, found) for length, found in sorted(by_length.items())]
        self.shingles = {}
        for size in {g.shingle for g in self.groups}:
            self.shingles[size] = np.unique(np.concatenate([g.known for g in self.groups if g.shingle == size]))

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        return np.fromiter((self.weights.get(x, self.rare) for x in shingles.tolist()), dtype=np.int64, count=len(shingles))

    def _group(self, length: int, found: list[tuple[int, np.ndarray]]) -> Items:
        size = min(SHINGLE, length)
        grams = [gram_hashes(h, size) for _, h in found]
        prints = np.array([_fingerprint(_votes(g, self.weight(g)).sum(axis=0)) for g in grams], dtype=np.uint64)
        values = np.arange(1 << _BLOCK_BITS, dtype=np.uint64)
        near = []
        for block in range(BLOCKS):
            own = (prints >> np.uint64(block * _BLOCK_BITS)) & np.uint64((1 << _BLOCK_BITS) - 1)
            near.append(np.bitwise_count(values[:, None] ^ own[None]) <= RADIUS // BLOCKS)
        return Items(length, size, [i for i, _ in found], [Counter(g.tolist()) for g in grams], prints, np.unique(np.concatenate(grams)), np.array(near))

    def similarity(self, one: dict[int, int], two: dict[int, int]) -> float:
        both = all_of = 0
        for x in one.keys() | two.keys():
            a, b, weight = one.get(x, 0), two.get(x, 0), self.weights.get(x, self.rare)
            both += weight * min(a, b)
            all_of += weight * max(a, b)
        return both / all_of


def _word_hashes(text: str) -> np.ndarray:
    data = lower_ascii(np.frombuffer(text.encode(), dtype=np.uint8))
    return words(data, np.array([0, len(data)])).hashes


def _windows_with(hit: np.ndarray, texts: np.ndarray, length: int, size: int) -> np.ndarray:
    """First words of all windows inside a text that hold one of the shingles at the given places."""
    reach = np.arange(length - size + 1)
    starts = np.unique((hit[:, None] - reach[None]).reshape(-1))
    starts = starts[starts >= 0]
    text = np.searchsorted(texts, starts, side="right")
    ends = np.append(texts, texts[-1])[np.minimum(text, len(texts) - 1)]
    return starts[(text < len(texts)) & (starts + length <= ends)]


def _short_texts(hit: np.ndarray, offsets: np.ndarray, length: int, size: int) -> np.ndarray:
    """Texts of fewer words than `length` that hold one of the shingles at the given places."""
    text = np.searchsorted(offsets, hit, side="right") - 1
    inside = hit + size <= offsets[text + 1]
    return np.unique(text[inside & (offsets[text + 1] - offsets[text] < length)])


def _search(hashes: np.ndarray, offsets: np.ndarray, index: Index) -> list[tuple[int, int, int, int, float, int]]:
    """Text, item, first word, words, similarity and distance of the best window of each pair."""
    grams = {size: gram_hashes(hashes, size) for size in index.shingles}
    hits = {}
    for size, known in index.shingles.items():
        at = np.minimum(np.searchsorted(known, grams[size]), len(known) - 1)
        hits[size] = np.flatnonzero(known[at] == grams[size])
    best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
    whole: dict[tuple[int, int], np.uint64] = {}
    for group in index.groups:
        own = grams[group.shingle]
        hit = hits[group.shingle]
        hit = hit[np.isin(own[hit], group.known)]
        if not len(hit):
            continue
        for text in _short_texts(hit, offsets, group.length, group.shingle).tolist():
            start, stop = int(offsets[text]), int(offsets[text + 1])
            mine = own[start : stop - group.shingle + 1]
            if (group.shingle, text) not in whole:
                whole[group.shingle, text] = _fingerprint(_votes(mine, index.weight(mine)).sum(axis=0))
            distance = np.bitwise_count(whole[group.shingle, text] ^ group.prints)
            for i in np.flatnonzero(distance <= RADIUS).tolist():
                similar = index.similarity(Counter(mine.tolist()), group.counts[i])
                if similar >= SIMILARITY:
                    found = (-similar, start, int(distance[i]), stop - start)
                    key = (text, group.ids[i])
                    best[key] = min(best.get(key, found), found)
        starts = _windows_with(hit, offsets[1:], group.length, group.shingle)
        inner = group.length - group.shingle + 1
        for first in range(0, len(starts), 2000):
            part = starts[first : first + 2000]
            places, where = np.unique(part[:, None] + np.arange(inner)[None], return_inverse=True)
            votes = _votes(own[places], index.weight(own[places]))
            sums = np.concatenate([np.zeros((1, 64), dtype=np.int64), np.cumsum(votes, axis=0)])
            # The places of a window are consecutive in `places`.
            low = where.reshape(len(part), inner)[:, 0]
            prints = _fingerprint(sums[low + inner] - sums[low])
            near = np.zeros((len(part), len(group.ids)), dtype=bool)
            for block in range(BLOCKS):
                value = (prints >> np.uint64(block * _BLOCK_BITS)) & np.uint64((1 << _BLOCK_BITS) - 1)
                near |= group.near[block][value.astype(np.int64)]
            window, item = np.nonzero(near)
            distance = np.bitwise_count(prints[window] ^ group.prints[item])
            for w, i, d in zip(window[distance <= RADIUS], item[distance <= RADIUS], distance[distance <= RADIUS]):
                start = int(part[w])
                similar = index.similarity(Counter(own[start : start + inner].tolist()), group.counts[i])
                if similar >= SIMILARITY:
                    text = int(np.searchsorted(offsets, start, side="right")) - 1
                    found = (-similar, start, int(d), group.length)
                    key = (text, group.ids[i])
                    best[key] = min(best.get(key, found), found)
    return [(t, i, s - int(offsets[t]), n, -q, d) for (t, i), (q, s, d, n) in sorted(best.items())]


FOUND = "key long, doc_id long, item_id long, start_word long, n_words long, similarity double, distance int"


def _found(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch["text"]):
            found = words(lower_ascii(chunk.data), chunk.offsets)
            rows = _search(found.hashes, found.offsets, index) if len(found.hashes) else []
            if rows:
                text, *rest = zip(*rows)
                at = pa.array([chunk.first + x for x in text])
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].take(at), batch["doc_id"].take(at), *(pa.array(x, k) for x, k in zip(rest, kinds))],
                    ["key", "doc_id", "item_id", "start_word", "n_words", "similarity", "distance"],
                )


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch["text"].to_pylist():
            hashes = _word_hashes(text)
            rows.append(np.unique(gram_hashes(hashes, min(SHINGLE, len(hashes)))).view(np.int64) if len(hashes) else [])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], ["shingles"])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES, has_keys: bool = False
) -> DataFrame:
    """Rows key, doc_id, item_id, start_word, n_words, similarity, distance.

    One row for each document and item with a window of the document that is
    similar to the item: the most similar window, the first of those. A document of
    fewer words than the item is compared as a whole. Words are cut
    at ASCII white space and A-Z made lower case. Items and texts that are NULL or
    without words match nothing; an item that is shorter than a shingle is one
    shingle. Rows that repeat an id: see `documents.keyed`, for both tables. The
    benchmark is searched for in passes of bounded size, each over all documents.
    """
    docs = docs if has_keys else keyed(docs)
    items = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = keyed(items).where("text IS NOT NULL").select(F.col("doc_id").alias("item_id"), "text")
    # An item cannot span passes, so a pass is as large as its share, or its one largest item.
    size = items.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    passes = max(1, -(-(size[0] or 0) // pass_bytes))
    rare = int(round(1000 * np.log1p(max(size[1], 1))))
    items = items.withColumn("turn", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    frequency = items.select("text").mapInArrow(_shingle_rows, "shingles array<bigint>")
    frequency = frequency.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count()
    result = None
    for turn in range(passes):
        mine = items.where(F.col("turn") == turn).select("item_id", "text")
        rows = [(x.item_id, x.text) for x in mine.collect()]
        own = mine.select("text").mapInArrow(_shingle_rows, "shingles array<bigint>")
        own = own.select(F.explode("shingles").alias("shingle")).distinct()
        weights = {
            x.shingle % (1 << 64): int(round(1000 * np.log1p(size[1] / x["count"])))
            for x in frequency.join(own, "shingle").collect()
        }
        found = docs.mapInArrow(partial(_found, index=Index(rows, weights, rare)), FOUND)
        result = found if result is None else result.unionAll(found)
    return result
