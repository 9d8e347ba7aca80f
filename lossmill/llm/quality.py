"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of kinds of characters and
words, and the same of the lines before and after it; the chain adds a weight for
each pair of neighbouring labels. In training all lines of a document carry the
document's label. A document's score is the mean, weighted by line length, of its
lines' probabilities of being good, from the forward-backward recursion.

The weights are fitted on a sample of labelled documents of bounded number and
size; scoring covers every document and its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import chunks, words

#: Bounds of the training sample: documents, and bytes of one document.
SAMPLE_DOCUMENTS = 3000
SAMPLE_BYTES = 40_000
STEPS = 120
RATE = 0.1
PENALTY = 1e-3
THRESHOLD = 0.3

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\"
#: Groups of bytes whose share of a line is a feature.
_GROUPS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", _MARKS, b".,;:", b"!?", b"#$%&*", b"|<>{}[]=_", bytes(range(128, 256))]
FEATURES = len(_GROUPS) + 9


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and bytes of all lines, and the number of each text's first line. A text has a line at least."""
    breaks = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    texts = len(offsets) - 1
    firsts = np.append(0, np.cumsum(np.bincount(owner, minlength=texts) + 1))
    lines = int(firsts[-1])
    starts, ends = np.zeros(lines, dtype=np.int64), np.zeros(lines, dtype=np.int64)
    place = firsts[owner] + np.arange(len(breaks)) - np.searchsorted(owner, owner)
    starts[firsts[:-1]] = offsets[:-1]
    starts[place + 1] = breaks + 1
    ends[firsts[1:] - 1] = offsets[1:]
    ends[place] = breaks
    size = ends - starts
    safe = np.maximum(size, 1).astype(np.float64)

    found = words(data, offsets)
    low, high = np.searchsorted(found.starts, starts), np.searchsorted(found.starts, ends)
    count = high - low
    per_word = np.maximum(count, 1).astype(np.float64)

    def share(flags: np.ndarray, a: np.ndarray, b: np.ndarray, of: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(flags))
        return (total[b] - total[a]) / of

    columns = []
    for group in _GROUPS:
        table = np.zeros(256, dtype=bool)
        table[list(group)] = True
        columns.append(share(table[data], starts, ends, safe))
    marks = np.zeros(256, dtype=bool)
    marks[list(_MARKS)] = True
    length = found.ends - found.starts
    last = data[found.ends - 1] if len(length) else np.zeros(0, dtype=np.uint8)
    before_last = data[np.maximum(found.ends - 2, found.starts)] if len(length) else last
    again = np.zeros(len(length), dtype=bool)
    again[1:] = found.hashes[1:] == found.hashes[:-1]
    line = np.repeat(np.arange(lines), count)
    in_lines = np.concatenate([found.hashes[:0], found.hashes[np.repeat(low, count) + np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)]])
    order = np.lexsort((in_lines, line))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (in_lines[order][1:] != in_lines[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=lines)
    columns += [
        share(length.astype(np.float64), low, high, per_word) / 10,
        share(length <= 3, low, high, per_word),
        share(length >= 12, low, high, per_word),
        share(marks[last], low, high, per_word),
        share(marks[last] & marks[before_last] & (length > 1), low, high, per_word),
        share(again, low, high, per_word),
        distinct / per_word,
        np.log1p(size) / 8,
        np.log1p(count) / 6,
    ]
    return np.stack(columns, axis=1), size, firsts


def chain_features(own: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A line's features with those of its neighbours in the text, and whether it has such."""
    lines = len(own)
    above, below = np.ones(lines, dtype=bool), np.ones(lines, dtype=bool)
    above[firsts[:-1]] = False
    below[firsts[1:] - 1] = False
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    after[:-1] = own[1:]
    before[~above] = own[~above]
    after[~below] = own[~below]
    edges = np.stack([np.ones(lines), above, below], axis=1)
    return np.concatenate([own, before, after, edges], axis=1)


@dataclass
class Field:
    """Weights of good against bad lines, of neighbouring labels (from, to; 0 bad, 1 good), and scaling."""

    weights: np.ndarray
    pairs: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def marginals(scores: np.ndarray, pairs: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for every line, and expected neighbour pairs, by forward-backward.

    Texts are taken side by side, position after position, longest first, so that
    those that still have a line are always the leading ones.
    """
    sizes = np.diff(firsts)
    order = np.argsort(-sizes, kind="stable")
    start, size = firsts[:-1][order], sizes[order]
    longest = int(size[0]) if len(size) else 0
    running = np.searchsorted(-size, -np.arange(longest), side="left")
    forward = np.zeros((len(scores), 2))
    backward = np.zeros((len(scores), 2))
    node = np.stack([np.zeros(len(scores)), scores], axis=1)
    message = np.zeros((len(size), 2))
    for t in range(longest):
        n = running[t]
        at = start[:n] + t
        if t:
            joint = message[:n, :, None] + pairs[None]
            message[:n] = np.logaddexp(joint[:, 0], joint[:, 1])
        message[:n] += node[at]
        message[:n] -= message[:n].max(axis=1, keepdims=True)
        forward[at] = message[:n]
    expected = np.zeros((2, 2))
    message = np.zeros((len(size), 2))
    for t in range(longest - 1, 0, -1):
        n = running[t]
        at = start[:n] + t
        ahead = message[:n] + node[at]
        joint = forward[at - 1][:, :, None] + pairs[None] + ahead[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        joint = pairs[None] + ahead[:, None, :]
        message[:n] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
        message[:n] -= message[:n].max(axis=1, keepdims=True)
        backward[at - 1] = message[:n]
    both = forward + backward
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700))), expected


def fit(features: np.ndarray, firsts: np.ndarray, labels: np.ndarray, steps: int = STEPS) -> Field:
    """Likelihood with a quadratic penalty, by gradient steps of adaptive size from zero weights."""
    width = features.shape[1]
    if len(labels) == 0:
        return Field(np.zeros(width), np.zeros((2, 2)), np.zeros(width), np.ones(width))
    mean, scale = features.mean(axis=0), features.std(axis=0)
    constant = scale < 1e-9
    mean[constant], scale[constant] = 0.0, 1.0
    scaled = (features - mean) / scale
    sizes = np.diff(firsts)
    target = np.repeat(labels, sizes).astype(np.float64)
    seen = np.zeros((2, 2))
    for value in (0, 1):
        seen[value, value] = (sizes - 1)[labels == value].sum()
    # Every document counts alike, whatever its number of lines.
    parameters = np.zeros(width + 4)
    first_moment, second_moment = np.zeros_like(parameters), np.zeros_like(parameters)
    total = len(target)
    for step in range(1, steps + 1):
        weights, pairs = parameters[:width], parameters[width:].reshape(2, 2)
        good, expected = marginals(scaled @ weights, pairs, firsts)
        gradient = np.concatenate([scaled.T @ (target - good), (seen - expected).reshape(-1)]) / total
        gradient -= PENALTY * parameters
        first_moment = 0.9 * first_moment + 0.1 * gradient
        second_moment = 0.999 * second_moment + 0.001 * gradient**2
        change = first_moment / (1 - 0.9**step) / (np.sqrt(second_moment / (1 - 0.999**step)) + 1e-8)
        parameters = parameters + RATE * change
    return Field(parameters[:width], parameters[width:].reshape(2, 2), mean, scale)


def text_scores(data: np.ndarray, offsets: np.ndarray, field: Field) -> np.ndarray:
    own, size, firsts = line_features(data, offsets)
    scaled = (chain_features(own, firsts) - field.mean) / field.scale
    good, _ = marginals(scaled @ field.weights, field.pairs, firsts)
    weight = np.maximum(size, 1).astype(np.float64)
    return np.clip(np.add.reduceat(good * weight, firsts[:-1]) / np.add.reduceat(weight, firsts[:-1]), 0, 1)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch["quality"].to_numpy()
        for chunk in chunks(batch["text"]):
            own, _, firsts = line_features(chunk.data, chunk.offsets)
            rows = [own[a:b].tobytes() for a, b in zip(firsts, firsts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(labels[chunk.first : chunk.first + chunk.rows], pa.int32())],
                ["lines", "quality"],
            )


def train(
    docs: DataFrame, labels: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES
) -> Field:
    """Fit the field on labelled documents that are not held out.

    At most `sample_documents` of them, by the hash of their ids, of at most
    `sample_bytes` each: their features are what comes to the driver. Ids with
    different labels, and labels that are NULL or neither 0 nor 1, are not used.
    Without any sample all weights are zero and every score is a half.
    """
    known = (
        labels.where("quality IN (0, 1)")
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL")
        .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where("quality = most")
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where(F.octet_length(F.coalesce("text", F.lit(""))) <= sample_bytes)
    chosen = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_documents).select("doc_id", "quality")
    # At most `sample_documents` rows of two numbers.
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .orderBy("doc_id", "text")
        .limit(sample_documents)
        .select("text", "quality")
        .mapInArrow(_sampled, "lines binary, quality int")
        .collect()
    )
    own = [np.frombuffer(bytes(x.lines), dtype=np.float64).reshape(-1, FEATURES) for x in rows]
    firsts = np.append(0, np.cumsum([len(x) for x in own])).astype(np.int64)
    lines = np.concatenate(own) if own else np.zeros((0, FEATURES))
    features = chain_features(lines, firsts) if own else np.zeros((0, 3 * FEATURES + 3))
    return fit(features, firsts, np.array([x.quality for x in rows], dtype=np.int64))


def _scored(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.schema.get_field_index("text")
        for chunk in chunks(batch["text"]):
            part = batch.slice(chunk.first, chunk.rows)
            scores = text_scores(chunk.data, chunk.offsets, field)
            columns = [x for i, x in enumerate(part.columns) if i != text]
            names = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], [*names, "score"])


def scored(docs: DataFrame, field: Field) -> DataFrame:
    """Rows doc_id, score: every row of the documents, NULL texts as empty ones.

    Rows that repeat an id, or have none, each keep their score.
    """
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(partial(_scored, field=field), "doc_id long, score double")


def _accepted(batches: Iterator[pa.RecordBatch], field: Field, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch["text"]):
            good = text_scores(chunk.data, chunk.offsets, field) >= threshold
            yield batch.slice(chunk.first, chunk.rows).filter(pa.array(good))


def accepted(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    return docs.mapInArrow(partial(_accepted, field=field, threshold=threshold), docs.schema)
