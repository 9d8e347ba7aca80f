"""Records of CSV files that Spark may split anywhere.

A quoted cell can hold line breaks, so a line need not be a record, and a task that
starts in the middle of a file does not know whether it starts inside quotes. Every
line is a small function: the state at its end for either state at its start. One
pass composes the functions of each split; run over the splits of a file, they give the
state in which each one starts. The second pass then forms records, each task from
its own lines. Only records over the end of a split are put together afterwards.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, ship

LINES = ["file", "start", "value", "outside", "inside"]
ENDS = "file string, start long, outside boolean, inside boolean, header string"
PARTS = "file string, start long, part int, first boolean, value string"
#: A whole record, the end of one that began in an earlier split, the beginning of one that goes on.
WHOLE, HEAD, TAIL = 0, 1, 2


@dataclass
class Records:
    """Records of files: columns file, first (of its file) and value; and the first line of each file."""

    frame: DataFrame
    ends: DataFrame
    #: Files that end inside quotes; there every line counts as a record.
    unclosed: list[str] = field(default_factory=list)


def quoted_cell(quote: str) -> str:
    """Pattern of a closed quoted cell, without the cell's surroundings."""
    q = re.escape(quote)
    return f"{q}[^{q}]*(?:{q}{q}[^{q}]*)*{q}"


def without_quoted_cells(raw: Column, sep: str, quote: str) -> Column:
    """A line outside quotes without its closed quoted cells."""
    pattern = f"(^|{re.escape(sep)}){quoted_cell(quote)}(?={re.escape(sep)}|$)"
    return F.when(F.contains(raw, F.lit(quote)), F.regexp_replace(raw, pattern, "$1")).otherwise(raw)


def _opens(line: Column, sep: str, quote: str) -> Column:
    """Whether a line that starts outside quotes ends inside: a cell that begins with a quote is not closed.

    A quote within an unquoted cell opens nothing, and with an even number of quotes
    a damaged cell is taken for closed.
    """
    begun = without_quoted_cells(line, sep, quote).rlike(f"(^|{re.escape(sep)}){re.escape(quote)}")
    marks = F.length(line) - F.length(F.replace(line, F.lit(quote), F.lit("")))
    # The count decides most lines before any pattern is tried.
    return (marks % 2 == 1) & begun


def _lines(spark: SparkSession, path: str | list[str], sep: str, quote: str) -> DataFrame:
    q, s = re.escape(quote), re.escape(sep)
    raw = F.col("value")
    closing = f"^[^{q}]*(?:{q}{q}[^{q}]*)*{q}(?={s}|$)"
    marked = F.contains(raw, F.lit(quote))
    stays = ~raw.rlike(closing) | _opens(F.regexp_replace(raw, closing, ""), sep, quote)
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        (marked & _opens(raw, sep, quote)).alias("outside"),
        F.when(marked, stays).otherwise(True).alias("inside"),
    )


def states(outside: np.ndarray, inside: np.ndarray, begin: bool) -> np.ndarray:
    """Whether each line starts inside quotes, and after the last entry the state at the end."""
    n = len(outside)
    fixed, turns = outside == inside, np.append(0, np.cumsum(outside & ~inside))
    last = np.append(-1, np.maximum.accumulate(np.where(fixed, np.arange(n), -1))) if n else np.array([-1])
    base = np.where(last >= 0, outside[np.maximum(last, 0)] if n else begin, begin)
    return base ^ ((turns - turns[last + 1]) % 2 == 1)


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Pieces of batches that belong to one split each, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, start = batch["file"].dictionary_encode().indices.to_numpy(), batch["start"].to_numpy()
        cuts = np.flatnonzero((np.diff(files) != 0) | (np.diff(start) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (batch["file"][a].as_py(), int(start[a])), batch.slice(a, b - a)


def _functions(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(part[c].to_numpy(zero_copy_only=False) for c in ("outside", "inside"))


def _first_text(part: pa.RecordBatch) -> str | None:
    return next((x for x in part["value"].to_pylist() if x), None)


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split the state at its end for either state at its start; of a file's first split its first line."""
    key, ends, header = None, (False, True), None

    def row() -> pa.RecordBatch:
        values = [[x] for x in (*key, *ends, header)]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], [c.split()[0] for c in ENDS.split(", ")])

    for own, part in _by_split(batches):
        if own != key:
            if key is not None:
                yield row()
            key, ends, header = own, (False, True), None
        functions = _functions(part)
        ends = tuple(bool(states(*functions, begin)[-1]) for begin in ends)
        if own[1] == 0 and header is None:
            header = _first_text(part)
    if key is not None:
        yield row()


def _split_records(batches: Iterator[pa.RecordBatch], begins: set, unclosed: set) -> Iterator[pa.RecordBatch]:
    """Records of each split, and what stands open at its ends."""
    key, state, held, part_of, titled = None, False, [], WHOLE, True
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal held, titled
        text = "\n".join(held)
        if text or kind != WHOLE:
            out.append((*key, kind, not titled, text))
            titled = True
        held = []

    def rows() -> pa.RecordBatch:
        nonlocal out
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
        columns = [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, kinds)]
        out = []
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PARTS.split(", ")])

    for own, part in _by_split(batches):
        if own != key:
            if held:
                close(HEAD if part_of == HEAD else TAIL)
            state, part_of = own in begins, HEAD if own in begins else WHOLE
            key, held, titled = own, [], own[1] != 0
        outside, inside = _functions(part)
        if own[0] in unclosed:
            outside, inside = np.zeros_like(outside), np.zeros_like(inside)
        begin = states(outside, inside, state)
        state = bool(begin[-1])
        alone = ~begin[:-1] & ~begin[1:]
        values = part["value"]
        if alone.all() and titled and not held:
            # Nothing but records of one line: no line is looked at by itself.
            yield pa.RecordBatch.from_arrays(
                [part["file"], part["start"], pa.array(np.zeros(len(alone), dtype=np.int32)), pa.array(np.zeros(len(alone), dtype=bool)), values],
                [c.split()[0] for c in PARTS.split(", ")],
            )
            continue
        for line, goes_on in zip(values.to_pylist(), begin[1:].tolist()):
            held.append(line)
            if not goes_on:
                close(part_of)
                part_of = WHOLE
        yield rows()
    if held:
        close(HEAD if part_of == HEAD else TAIL)
    yield rows()


def read_records(spark: SparkSession, path: str | list[str], sep: str, quote: str) -> Records:
    """Records of all files of a path, in splits of any size.

    A line break inside a quoted cell is a line feed in the record, whatever it was
    in the file. Empty lines outside quotes are no records. A file in which a quoted
    cell is never closed is read line by line. The state at the start of splits is
    worked out on the driver from one row per split, of those files only that have a
    split with an open end.
    """
    ship(spark)
    lines = _lines(spark, path, sep, quote)
    ends = cut_lineage(lines.mapInArrow(_split_ends, ENDS))
    open_files = ends.where("outside").select("file").distinct()
    begins, unclosed, state, before = set(), set(), False, None
    for file, start, outside, inside in (
        ends.join(open_files, "file", "left_semi").select("file", "start", "outside", "inside").orderBy("file", "start").collect()
    ):
        if file != before:
            unclosed |= {before} if state else set()
            state, before = False, file
        if state:
            begins.add((file, start))
        state = inside if state else outside
    unclosed |= {before} if state else set()
    begins = {b for b in begins if b[0] not in unclosed}
    parts = lines.mapInArrow(partial(_split_records, begins=begins, unclosed=unclosed), PARTS)
    frame = parts
    if begins:
        parts = cut_lineage(parts)
        in_order = Window.partitionBy("file").orderBy("start", "part")
        pieces = parts.where(F.col("part") != WHOLE).withColumn("record", F.sum((F.col("part") == TAIL).cast("int")).over(in_order))
        joined = pieces.groupBy("file", "record").agg(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "part", "value"))), lambda x: x.value), "\n").alias("value"),
            F.max("first").alias("first"),
        )
        frame = parts.where(F.col("part") == WHOLE).select("file", "first", "value").union(joined.select("file", "first", "value"))
    return Records(frame.select("file", "first", "value"), ends.where("header IS NOT NULL").select("file", "header"), sorted(unclosed))
