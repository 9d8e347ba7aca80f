"""Exact interpolated quantiles of distributed columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Cells of one histogram.
CELLS = 1024


def exact_quantile(frame: DataFrame, column: str, share: float) -> float | None:
    """Linear-interpolated quantile over the finite values of a column."""
    return exact_quantiles(frame, [(F.col(column), share)])[0]


def exact_quantiles(frame: DataFrame, wanted: list[tuple[Column, float]]) -> list[float | None]:
    """Linear-interpolated quantiles of several expressions; None where there is no value.

    The built-in exact percentile holds all distinct values in one task, and a sort
    moves them all. Here a rank is found by narrowing: the values between two bounds
    are counted in a histogram of `CELLS` cells, with the least and the largest value of
    each, and the cell with the rank gives the next bounds, until both are one value.
    All ranks of all quantiles share every pass, and only counts leave the tasks. NULL,
    NaN and infinite values take no part.
    """
    names = [f"v{i}" for i in range(len(wanted))]
    doubles = [value.cast("double") for value, _ in wanted]
    finite = [F.when(F.abs(v) < math.inf, v).alias(n) for v, n in zip(doubles, names)]
    values = cut_lineage(frame.select(*finite))
    totals = values.agg(*[f(n).alias(f"{k}{n}") for n in names for k, f in (("n", F.count), ("a", F.min), ("b", F.max))]).first()
    # Where each rank lies: bounds of its value, and how many values are below them.
    places: dict[tuple[str, int], tuple[float, float, int]] = {}
    for name, (_, share) in zip(names, wanted):
        n = totals[f"n{name}"]
        if n:
            rank = math.floor(share * (n - 1))
            for r in {rank, min(rank + 1, n - 1)}:
                places[name, r] = (totals[f"a{name}"], totals[f"b{name}"], 0)
    while open_ := sorted({(name, *bounds) for (name, _), bounds in places.items() if bounds[0] < bounds[1]}):
        found = _histograms(values, open_)
        for (name, rank), bounds in places.items():
            if (name, *bounds) in open_:
                below = bounds[2]
                for n, least, most in found[open_.index((name, *bounds))]:
                    if rank < below + n:
                        places[name, rank] = (least, most, below)
                        break
                    below += n
    result: list[float | None] = []
    for name, (_, share) in zip(names, wanted):
        n = totals[f"n{name}"]
        if not n:
            result.append(None)
            continue
        position = share * (n - 1)
        rank = math.floor(position)
        lower, upper = places[name, rank][0], places[name, min(rank + 1, n - 1)][0]
        result.append(lower + (upper - lower) * (position - rank))
    return result


def _histograms(values: DataFrame, bounds: list[tuple[str, float, float, int]]) -> list[list[tuple[int, float, float]]]:
    """For each pair of bounds the cells in order: count, least and largest value."""
    kind = "struct<w:int,cell:int,v:double>"
    rows = []
    for i, (name, low, high, _) in enumerate(bounds):
        v = F.col(name)
        # A range too wide for a double is measured in halves.
        part = 1.0 if math.isfinite(high - low) else 0.5
        share = (v * part - F.lit(low * part)) / F.lit(high * part - low * part)
        cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("int")
        row = F.struct(F.lit(i).alias("w"), cell.alias("cell"), v.alias("v")).cast(kind)
        rows.append(F.when(v.between(low, high), row))
    dealt = values.select(F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("r"))
    counted = dealt.groupBy("r.w", "r.cell").agg(F.count("*").alias("n"), F.min("r.v").alias("a"), F.max("r.v").alias("b"))
    found: list[list] = [[] for _ in bounds]
    for w, _, n, least, most in sorted(counted.collect()):
        found[w].append((n, least, most))
    return found
