"""Texts without their removed windows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textscan import chunks, cover, runs, words

SCHEMA = "key long, doc_id long, size long, removed long, spans array<struct<start:long,length:long>>, kept binary"
_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])
_ARROW = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int64()), ("removed", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept", pa.binary())]
)


def _kept(batches: Iterator[pa.RecordBatch], symbols: str, length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["marks"]
        ends = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        flat = lists.flatten()
        starts, counts = flat.field("start").to_numpy(), flat.field("windows").to_numpy()
        for chunk in chunks(batch["text"]):
            found = words(chunk.data, chunk.offsets) if symbols == "words" else None
            offsets = chunk.offsets if found is None else found.offsets
            part = slice(ends[chunk.first], ends[chunk.first + chunk.rows])
            owner = np.repeat(np.arange(chunk.rows), np.diff(ends[chunk.first : chunk.first + chunk.rows + 1]))
            begin = offsets[owner] + starts[part]
            gone = cover(begin, begin + counts[part] + length - 1, int(offsets[-1]))
            out: dict[str, list] = {"size": [], "removed": [], "spans": [], "kept": []}
            for row in range(chunk.rows):
                first, last = int(offsets[row]), int(offsets[row + 1])
                mask = gone[first:last]
                raw = chunk.data[chunk.offsets[row] : chunk.offsets[row + 1]]
                lost = int(mask.sum())
                if found is not None:
                    pieces = raw.tobytes().split()
                    kept = b" ".join(compress(pieces, (~mask).tolist()) if lost else pieces)
                else:
                    kept = (raw[~mask] if lost else raw).tobytes()
                spans = [{"start": int(a), "length": int(b - a)} for a, b in zip(*runs(mask))] if lost else []
                for name, value in zip(out, (last - first, lost, spans, kept)):
                    out[name].append(value)
            rows = slice(chunk.first, chunk.first + chunk.rows)
            yield pa.RecordBatch.from_pydict(
                {"key": batch["key"][rows], "doc_id": batch["doc_id"][rows], **out}, schema=_ARROW
            )


def without(docs: DataFrame, marks: DataFrame, symbols: str, length: int) -> DataFrame:
    """Every document with its marked windows (key, start, windows) taken out.

    Columns: key, doc_id, size (symbols of the text), removed, spans (maximal runs
    of removed symbols) and kept (what is left: words joined by one space, or bytes).
    """
    of_text = marks.groupBy("key").agg(F.collect_list(F.struct("start", "windows")).alias("marks"))
    return (
        docs.join(of_text, "key", "left")
        .select("key", "doc_id", "text", "marks")
        .mapInArrow(partial(_kept, symbols=symbols, length=length), SCHEMA)
    )
