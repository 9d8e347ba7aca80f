"""Error-tolerant CSV reading.

A short row is kept and padded with NULL; a row with a cell that does not parse, with
too many cells or with an open quote is rejected. Neither stock reader mode does all
of it, so records are split into cells of text, and cast afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .records import read_records, without_quoted_cells

RAW_ROW = "_raw_row"
SEPARATORS = (",", ";", "\t", "|")
QUOTES = ('"', "'")
#: Types from narrow to wide; what fits none is text.
KINDS = (T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType(), T.BooleanType())
#: Share of a column's cells that may fail to parse without making it text.
EXCEPTIONS = 0.01


def read_csv_tolerant(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
) -> DataFrame:
    """Read the declared columns of CSV files, keeping every usable row.

    With a header, the first line of each file names its columns: they are found by
    name in any order, which may differ from file to file, and others are ignored; a
    declared column that is missing is an error. Without one, columns are taken in the
    declared order. Whole numbers may be written as decimals or with an exponent.
    Quoted cells may hold line breaks; files are split over tasks all the same.
    """
    rows = _parsed(spark, path, schema, header, sep, quote)
    return rows.where("_keep").select(*[f.name for f in schema.fields])


def rejected_rows(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    sep: str = ",",
    quote: str = '"',
) -> DataFrame:
    """The records that `read_csv_tolerant` rejects, to be counted or looked at."""
    return _parsed(spark, path, schema, header, sep, quote).where("NOT _keep").select(RAW_ROW)


def _parsed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, header: bool, sep: str, quote: str
) -> DataFrame:
    """Declared columns, the raw row, and whether it is kept."""
    found = read_records(spark, path, sep, quote)
    if not header:
        return _cast(found.frame, schema, [f.name for f in schema.fields], sep, quote)
    # As many rows as different headers, usually one.
    headers = [r[0] for r in found.ends.select("header").distinct().orderBy("header").collect()]
    data, parts = found.frame.where("NOT first"), []
    for line in headers:
        names = _split_line(spark, line, sep, quote)
        missing = [f.name for f in schema.fields if f.name not in names]
        if missing:
            raise ValueError(f"columns {missing} are not in the header {names}")
        files = found.ends.where(F.col("header") == line).select("file")
        own = data if len(headers) == 1 else data.join(files, "file", "left_semi")
        parts.append(_cast(own, schema, names, sep, quote))
    if not parts:
        return _cast(found.frame, schema, [f.name for f in schema.fields], sep, quote)
    return reduce(DataFrame.union, parts)


def _split_line(spark: SparkSession, line: str, sep: str, quote: str) -> list[str]:
    """Cells of a header."""
    row = spark.createDataFrame([(line.lstrip("﻿"),)], "value string")
    width = row.select(_cells(F.col("value"), sep, quote)).first()[0]
    cells = row.select(_texts(F.col("value"), width, sep, quote)).first()[0]
    return [(x or "").strip() for x in cells]


def _texts(raw: Column, width: int, sep: str, quote: str) -> Column:
    """The cells of a record as text, c0, c1 and so on."""
    cells = ", ".join(f"c{i} string" for i in range(width))
    return F.from_csv(raw, cells, {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE"})


def _cast(records: DataFrame, schema: T.StructType, names: list[str], sep: str, quote: str) -> DataFrame:
    raw = F.col("value")
    rows = records.select(raw.alias(RAW_ROW), _texts(raw, len(names), sep, quote).alias("cells")).select(RAW_ROW, "cells.*")
    keep, columns = _cells(F.col(RAW_ROW), sep, quote) <= len(names), []
    for f in schema.fields:
        cell = F.col(f"c{names.index(f.name)}")
        value = _value(cell, f.dataType)
        keep = keep & (cell.isNull() | value.isNotNull())
        columns.append(value.alias(f.name))
    return rows.select(*columns, RAW_ROW, keep.alias("_keep"))


def _value(cell: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return cell
    if isinstance(kind, T.IntegralType):
        number = F.when(cell.rlike(r"[.eE]"), cell.try_cast("decimal(38,10)"))
        return F.coalesce(cell.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    return cell.try_cast(kind)


def _cells(raw: Column, sep: str, quote: str) -> Column:
    """Number of cells in a record; separators inside quotes do not count.

    A quote that opens a cell and is not closed makes the record too wide.
    """
    outside = without_quoted_cells(raw, sep, quote)
    count = F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit(""))) + 1
    marks = F.length(raw) - F.length(F.replace(raw, F.lit(quote), F.lit("")))
    return F.when(marks % 2 == 1, F.lit(1 << 30)).otherwise(count)


@dataclass(frozen=True)
class Dialect:
    """How files are written: separator, quote, whether a header names the columns, and their types."""

    sep: str
    quote: str
    header: bool
    schema: T.StructType


def detect_separator(spark: SparkSession, path: str | list[str]) -> tuple[str, str]:
    """Separator and quote that split most lines into the same number of cells, and into most; one pass over all lines."""
    raw = F.col("value")
    ways = [(s, q) for s in SEPARATORS for q in QUOTES]
    counts = F.array(*[F.struct(F.lit(i).alias("way"), _cells(raw, s, q).alias("cells")) for i, (s, q) in enumerate(ways)])
    lines = spark.read.text(path).where(F.length("value") > 0)
    found = lines.select(F.explode(counts).alias("c")).groupBy("c.way", "c.cells").count().collect()
    if not found:
        return ways[0]

    def rank(way: int) -> tuple[float, int, int]:
        own = {cells: n for w, cells, n in found if w == way}
        usual = max(own, key=lambda c: (own[c], c))
        return (own[usual] / sum(own.values()) if 1 < usual < 1 << 30 else 0.0, usual, -way)

    return ways[max(range(len(ways)), key=rank)]


def detect_dialect(
    spark: SparkSession,
    path: str | list[str],
    header: bool | None = None,
    sep: str | None = None,
    quote: str | None = None,
    exceptions: float = EXCEPTIONS,
) -> Dialect:
    """Separator, quote, types and header, each from all lines.

    A column has the narrowest type that its cells allow; up to a share of
    `exceptions` of them may not parse, they are damage and not text. Without a
    `header` given, there is one if the first line of the first file does not parse
    where its column does, or if all columns are text. Names without a header are
    column0, column1 and so on.
    """
    found_sep, found_quote = (sep, quote) if sep and quote else detect_separator(spark, path)
    sep, quote = sep or found_sep, quote or found_quote
    records = read_records(spark, path, sep, quote)
    first = records.ends.orderBy("file").limit(1).collect()
    if not first:
        return Dialect(sep, quote, bool(header), T.StructType([]))
    names = _split_line(spark, first[0]["header"], sep, quote)
    # First lines are left out here, whether they are headers or not.
    texts = _texts(F.col("value"), len(names), sep, quote)
    cells = records.frame.where("NOT first").select(texts.alias("c")).select("c.*")
    sums = [F.count(f"c{i}") for i in range(len(names))]
    for i in range(len(names)):
        sums += [F.count(_value(F.col(f"c{i}"), kind)) for kind in KINDS]
    counts = list(cells.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first())
    told = spark.createDataFrame([tuple(x or None for x in names)], ", ".join(f"c{i} string" for i in range(len(names))))
    kinds, told_kinds = [], told.select(*[_value(F.col(f"c{i}"), k).isNotNull().alias(f"k{i}_{j}") for i in range(len(names)) for j, k in enumerate(KINDS)]).first()
    clash = False
    for i in range(len(names)):
        total, fits = counts[i], counts[len(names) + i * len(KINDS) :][: len(KINDS)]
        place = next((j for j, n in enumerate(fits) if total and n >= total * (1 - exceptions)), None)
        kinds.append(T.StringType() if place is None else KINDS[place])
        clash |= place is not None and bool(names[i]) and not told_kinds[i * len(KINDS) + place]
    if header is None:
        header = clash or all(isinstance(k, T.StringType) for k in kinds)
    if not header:
        names = [f"column{i}" for i in range(len(kinds))]
    return Dialect(sep, quote, header, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))


def infer_csv_schema(
    spark: SparkSession, path: str | list[str], header: bool | None = True, sep: str | None = None
) -> T.StructType:
    """Names and types of files without a declared schema (see `detect_dialect`)."""
    return detect_dialect(spark, path, header, sep).schema


def read_csv_auto(spark: SparkSession, path: str | list[str], header: bool | None = None) -> DataFrame:
    """Read files about which nothing is known: separator, quote, header and types are found first."""
    found = detect_dialect(spark, path, header)
    return read_csv_tolerant(spark, path, found.schema, found.header, found.sep, found.quote)
