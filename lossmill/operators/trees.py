"""Regression trees grown level by level on histograms of gradient and curvature.

A factor's values are numbered once: a category by its place among the names, a
number by the cuts between its different values. A level of a tree needs the sums
per node, factor and number of the smaller child of each split; those of its sibling
are what is left of the parent's. Where the sums come from is up to the caller: a task
adds up its own rows, all of them or those of its block, or Spark aggregates a frame.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves of a tree up to which a set of them is one number.
MASK_BITS = 64
#: Rows for each number of two factors together from which a node's sums are formed for both in one.
ROWS_PER_PAIR = 16
#: Rows of a task from which that is done; the sums of fewer take little time in any way, and keep their order.
LEAST_PAIRED = 100_000
#: Numbers of several factors together up to which they are one code.
MOST_CODES = 1 << 15
#: NumPy's fastest way of taking from known places.
QUICK = "clip"
#: Rows that are looked at together.
PIECE = 1 << 15


def grouped(sizes: tuple[int, ...], most: int) -> list[list[int]]:
    """Factors in as few groups as can be, so that a group's numbers together are at most `most`, unless it is one factor."""
    order = sorted(range(len(sizes)), key=lambda f: -sizes[f])
    for count in range(1, len(order) + 1):
        groups, products = [[] for _ in range(count)], [1] * count
        for f in order:
            at = products.index(min(products))
            groups[at].append(f)
            products[at] *= sizes[f]
        if max(products) <= most:
            return groups
    return [[f] for f in order]


@dataclass(frozen=True)
class Grid:
    """How values become numbers: the names of a category, the cuts of a number, the other one None."""

    columns: tuple[str, ...]
    labels: tuple[tuple[str, ...] | None, ...]
    cuts: tuple[tuple[float, ...] | None, ...]

    @classmethod
    def fit(cls, rows: DataFrame, columns: tuple[str, ...], categories: tuple[str, ...], most: int | None) -> Grid:
        """Cut between all values of a number.

        Where it has more than `most` values, cut between approximate percentiles of
        all rows; `most=None` cuts between all of them, however many there are.
        """

        def of(name: str) -> tuple[tuple[str, ...] | None, tuple[float, ...] | None]:
            different = rows.select(name).distinct().orderBy(name)
            if name in categories:
                return tuple(r[0] for r in different.collect()), None
            values = [r[0] for r in (different if most is None else different.limit(most + 1)).collect()]
            if most is None or len(values) <= most:
                return None, tuple((a + b) / 2 for a, b in zip(values, values[1:]))
            shares = [i / most for i in range(1, most)]
            found = rows.agg(F.percentile_approx(name, shares, 100 * most)).first()[0]
            return None, tuple(sorted(set(found)))

        # The factors' jobs are small and wait for each other only in the driver.
        with ThreadPoolExecutor(len(columns)) as pool:
            labels, cuts = zip(*pool.map(inheritable_thread_target(rows.sparkSession)(of), columns))
        return cls(tuple(columns), labels, cuts)

    @property
    def sizes(self) -> tuple[int, ...]:
        """Numbers of each factor; an unknown category has one of its own."""
        return tuple(len(a if a is not None else b) + 1 for a, b in zip(self.labels, self.cuts))

    @property
    def starts(self) -> np.ndarray:
        """Where a factor's numbers begin in a histogram of all factors."""
        return np.cumsum([0, *self.sizes])

    @cached_property
    def pairs(self) -> list[tuple[int, int]]:
        """The factors two by two, the largest with the smallest; of an odd number one is left alone."""
        order = np.argsort(self.sizes, kind="stable").tolist()
        half = len(order) // 2
        return list(zip(order[:half], reversed(order[-half:]))) if half else []

    @cached_property
    def groups(self) -> list[list[int]]:
        return grouped(self.sizes, MOST_CODES)

    def shape(self, group: list[int]) -> tuple[int, ...]:
        return tuple(self.sizes[f] for f in group)

    def codes(self, numbers: np.ndarray) -> list[np.ndarray]:
        """For each group one code of the numbers of its factors."""
        found = []
        for group in self.groups:
            code = np.ravel_multi_index([numbers[f].astype(np.int64) for f in group], self.shape(group))
            found.append(code.astype(np.min_scalar_type(math.prod(self.shape(group)))))
        return found

    def numbers(self, values: list[np.ndarray]) -> np.ndarray:
        """Numbers of the rows' values, one row per factor; categories come as their places."""
        found = [x.astype(np.int64) if cuts is None else np.searchsorted(np.array(cuts), x) for x, cuts in zip(values, self.cuts)]
        return np.array(found, dtype=np.int64)

    def column(self) -> Column:
        """Array of the numbers of a row's factors."""
        found = []
        for name, labels, cuts in zip(self.columns, self.labels, self.cuts):
            if cuts is None:
                place = F.array_position(F.array(*map(F.lit, labels)), F.col(name))
                found.append(F.when(place > 0, place - 1).otherwise(len(labels)).cast("int"))
            else:
                found.append(_below(F.col(name), cuts))
        return F.array(*found)


@dataclass
class Tree:
    """Nodes in heap order from 1: the factor asked (-1: none), the numbers that go left, the sums of its rows."""

    factor: np.ndarray
    goes: np.ndarray
    sums: np.ndarray

    @classmethod
    def of_depth(cls, depth: int, width: int) -> Tree:
        heap = 2 << depth
        return cls(np.full(heap, -1), np.zeros((heap, width), dtype=bool), np.zeros((3, heap)))

    def descend(self, node: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The nodes of rows after one more question."""
        asked = self.factor[node]
        row = np.flatnonzero(asked >= 0)
        node = node.copy()
        goes = self.goes[node[row], numbers[asked[row], row]]
        node[row] = 2 * node[row] + 1 - goes
        return node

    def leaves(self, numbers: np.ndarray) -> np.ndarray:
        """The nodes that rows end in, as far as the tree is grown; up to `MASK_BITS` leaves without walking down."""
        ends = self._ends(1)
        if len(ends) > MASK_BITS:
            node = np.ones(numbers.shape[1], dtype=np.int64)
            for _ in range(len(self.factor).bit_length() - 2):
                node = self.descend(node, numbers)
            return node
        masks = self._masks(numbers.shape[0], ends)
        open_ = masks[0].take(numbers[0])
        for mask, own in zip(masks[1:], numbers[1:]):
            open_ &= mask.take(own)
        return np.concatenate([np.zeros(1023, dtype=np.int64), ends]).take(leaf_place(open_))

    def ends(self) -> list[int]:
        """The leaves as far as the tree is grown."""
        return self._ends(1)

    def _ends(self, node: int) -> list[int]:
        """The leaves below a node from left to right."""
        return [node] if self.factor[node] < 0 else [*self._ends(2 * node), *self._ends(2 * node + 1)]

    def _masks(self, factors: int, ends: list[int]) -> np.ndarray:
        """Per factor and number the leaves that it leaves open, as bits; only the one that is reached is left by all."""
        masks = np.full((factors, self.goes.shape[1]), (1 << len(ends)) - 1, dtype=np.uint64)

        def closed(node: int, first: int) -> int:
            if self.factor[node] < 0:
                return first + 1
            middle = closed(2 * node, first)
            last = closed(2 * node + 1, middle)
            lower, upper = (1 << middle) - (1 << first), (1 << last) - (1 << middle)
            masks[self.factor[node]] &= ~np.where(self.goes[node], np.uint64(upper), np.uint64(lower))
            return last

        closed(1, 0)
        return masks


def leaf_place(mask: np.ndarray) -> np.ndarray:
    """Exponent of masks with one bit as they are in a double: the bit's place and 1023."""
    return mask.astype(np.float64).view(np.int64) >> 52


#: Sums of gradient, curvature and rows of the given nodes, for every factor and number.
Sums = Callable[[Tree, list[int]], np.ndarray]


def _table(values: np.ndarray) -> Column:
    """Constant array. Plans with other values in it share their compiled code."""
    kind = "double" if values.dtype.kind == "f" else "int"
    if not len(values):
        return F.expr(f"cast(array() as array<{kind}>)")
    return F.expr("cast(split('" + ",".join(map(repr, values.tolist())) + f"', ',') as array<{kind}>)")


def _below(value: Column, cuts: tuple[float, ...]) -> Column:
    """How many cuts lie below a value."""
    return F.size(F.filter(_table(np.array(cuts, dtype=float)), lambda cut: cut < value))


def with_node(rows: DataFrame, tree: Tree, depth: int) -> DataFrame:
    """Add the node of each row (column _bins) after `depth` questions."""
    rows = rows.withColumn("_node", F.lit(1))
    factor, goes = _table(tree.factor), _table(tree.goes.astype(np.int64).reshape(-1))
    for _ in range(depth):
        asked = F.get(factor, F.col("_node"))
        number = F.col("_node") * tree.goes.shape[1] + F.get("_bins", asked)
        rows = rows.withColumn("_node", F.when(asked >= 0, F.col("_node") * 2 + 1 - F.get(goes, number)).otherwise(F.col("_node")))
    return rows


def frame_sums(rows: DataFrame, grid: Grid) -> Sums:
    """Sums by one aggregation per level over a frame with _bins, _gradient and _curvature."""

    def sums(tree: Tree, nodes: list[int]) -> np.ndarray:
        depth = nodes[0].bit_length() - 1
        own = with_node(rows, tree, depth).where(F.col("_node").isin(nodes))
        split = own.select("_node", "_gradient", "_curvature", F.posexplode("_bins").alias("_factor", "_bin"))
        found = split.groupBy("_node", "_factor", "_bin").agg(
            F.sum("_gradient").alias("g"), F.sum("_curvature").alias("h"), F.count("*").cast("double").alias("n")
        )
        found = found.toArrow()
        result = np.zeros((3, len(nodes), int(grid.starts[-1])))
        node = np.searchsorted(nodes, found["_node"].to_numpy())
        at = grid.starts[found["_factor"].to_numpy()] + found["_bin"].to_numpy()
        for i, name in enumerate("ghn"):
            result[i, node, at] = found[name].to_numpy()
        return result

    return sums


class TaskRows:
    """A task's rows by the node that they are in; a question divides those of its node only."""

    def __init__(self, numbers: np.ndarray, rows: np.ndarray | None = None):
        self.numbers = numbers
        self.rows = {1: np.arange(numbers.shape[1]) if rows is None else rows}

    def descend(self, tree: Tree) -> None:
        """Rows go down as far as the tree is grown."""
        todo = [node for node in self.rows if tree.factor[node] >= 0]
        while todo:
            node = todo.pop()
            row = self.rows.pop(node)
            left = tree.goes[node].take(self.numbers[tree.factor[node]].take(row))
            for child, own in ((2 * node, left), (2 * node + 1, ~left)):
                self.rows[child] = row.take(np.flatnonzero(own))  # several times faster than row[own]
                if tree.factor[child] >= 0:
                    todo.append(child)


class TaskSums(TaskRows):
    """Sums of a task's own rows, added up in their order; in nodes of many rows by two factors together.

    `paired`: the numbers of the grid's pairs of factors, where they are known (see `paired`).
    """

    def __init__(
        self, numbers: np.ndarray, grid: Grid, gradient: np.ndarray, curvature: np.ndarray, paired: list[np.ndarray] | None = None
    ):
        super().__init__(numbers, np.flatnonzero(curvature > 0))
        self.grid, self.gradient, self.curvature, self.paired = grid, gradient, curvature, paired

    def __call__(self, tree: Tree, nodes: list[int]) -> np.ndarray:
        self.descend(tree)
        starts, sizes = self.grid.starts, self.grid.sizes
        result = np.zeros((3, len(nodes), int(starts[-1])))
        for place, node in enumerate(nodes):
            row = self.rows[node]
            every = len(row) == self.numbers.shape[1]
            weights = [x if every else x.take(row) for x in (self.gradient, self.curvature)]
            alone = range(len(sizes))
            if self.paired is not None and len(row) >= ROWS_PER_PAIR * max(sizes[a] * sizes[b] for a, b in self.grid.pairs):
                alone = [f for f in alone if not any(f in pair for pair in self.grid.pairs)]
                for (a, b), numbers in zip(self.grid.pairs, self.paired):
                    at = (numbers if every else numbers.take(row)).astype(np.int64, copy=False)
                    for i, weight in enumerate((*weights, None)):
                        both = np.bincount(at, weight, minlength=sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
                        result[i, place, starts[a] : starts[a + 1]] = both.sum(axis=1)
                        result[i, place, starts[b] : starts[b + 1]] = both.sum(axis=0)
            for f in alone:
                at = (self.numbers[f] if every else self.numbers[f].take(row)).astype(np.int64, copy=False)
                for i, weight in enumerate((*weights, None)):
                    result[i, place, starts[f] : starts[f + 1]] = np.bincount(at, weight, minlength=sizes[f])
        return result


class Reached:
    """Some nodes of a tree, none below another and at most `MASK_BITS`, and which rows get to them by their codes.

    A code of a group leaves some nodes open; a row is in the one that all its codes do,
    so that no row has to walk down.
    """

    def __init__(self, grid: Grid, tree: Tree, nodes: list[int]):
        self.nodes, every = nodes, (1 << len(nodes)) - 1
        kind = np.min_scalar_type(every)
        masks = [np.full(size, every, dtype=kind) for size in grid.sizes]
        for i, node in enumerate(nodes):
            while node > 1:
                asked = tree.factor[node >> 1]
                goes = tree.goes[node >> 1, : grid.sizes[asked]]
                masks[asked][~goes if node % 2 == 0 else goes] &= kind.type(every ^ (1 << i))
                node >>= 1
        self.tables = []
        for group in grid.groups:
            table = masks[group[0]]
            for f in group[1:]:
                table = np.bitwise_and.outer(table, masks[f])
            self.tables.append(table.reshape(-1))

    def pieces(self, codes: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray | int]]:
        """Some rows and the places of their nodes, `PIECE` rows after the other: what is made of so many stays in the cache."""
        for first in range(0, len(codes[0]), PIECE):
            if self.nodes == [1]:
                yield np.arange(first, min(first + PIECE, len(codes[0]))), 0
                continue
            open_ = self.tables[0].take(codes[0][first : first + PIECE], mode=QUICK)
            for table, code in zip(self.tables[1:], codes[1:]):
                open_ &= table.take(code[first : first + PIECE], mode=QUICK)
            row = np.flatnonzero(open_)
            yield row + first, leaf_place(open_.take(row)) - 1023 if len(self.nodes) > 1 else 0

    @classmethod
    def in_parts(cls, grid: Grid, tree: Tree, nodes: list[int]) -> Iterator[Reached]:
        return (cls(grid, tree, nodes[i : i + MASK_BITS]) for i in range(0, len(nodes), MASK_BITS))


def code_sums(codes: list[np.ndarray], grid: Grid, graded: Callable, tree: Tree, nodes: list[int]) -> np.ndarray:
    """Sums of rows given by their codes; `graded`: gradient and curvature of some rows.

    Where there are enough rows they are added up by code and node, which gives the sums of
    all factors of a group at once.
    """
    result, done, many = np.zeros((3, len(nodes), int(grid.starts[-1]))), 0, len(codes[0])
    for part in Reached.in_parts(grid, tree, nodes):
        places, weights, used = [np.empty(many, dtype=np.int64) for _ in codes], np.empty((2, many)), 0
        sizes = [math.prod(grid.shape(group)) for group in grid.groups]
        for row, place in part.pieces(codes):
            for at, code, size in zip(places, codes, sizes):
                at[used : used + len(row)] = code.take(row, mode=QUICK) + place * size
            weights[:, used : used + len(row)] = graded(row)
            used += len(row)
        count = len(part.nodes)
        held, weights = result[:, done : done + count], [*weights[:, :used], None]
        done += count
        for group, at, size in zip(grid.groups, places, sizes):
            at, shape = at[:used], (count, *grid.shape(group))
            if used >= count * size:
                for i, weight in enumerate(weights):
                    sums = np.bincount(at, weight, minlength=count * size).reshape(shape)
                    for own, f in enumerate(group):
                        rest = tuple(k + 1 for k in range(len(group)) if k != own)
                        held[i, :, grid.starts[f] : grid.starts[f + 1]] = sums.sum(axis=rest)
                continue
            place, *numbers = np.unravel_index(at, shape)
            for number, f in zip(numbers, group):
                for i, weight in enumerate(weights):
                    sums = np.bincount(place * grid.sizes[f] + number, weight, minlength=count * grid.sizes[f])
                    held[i, :, grid.starts[f] : grid.starts[f + 1]] = sums.reshape(count, -1)
    return result


def paired(numbers: np.ndarray, grid: Grid) -> list[np.ndarray] | None:
    """Numbers of every pair of factors; None where no node can have rows enough for them."""
    sizes = grid.sizes
    most = max((sizes[a] * sizes[b] for a, b in grid.pairs), default=0)
    if not most or numbers.shape[1] < max(LEAST_PAIRED, ROWS_PER_PAIR * most):
        return None
    kind = np.min_scalar_type(most)
    return [numbers[a].astype(kind) * kind.type(sizes[b]) + numbers[b] for a, b in grid.pairs]


def _best_splits(sums: np.ndarray, ordered: bool, penalty: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain of each node's best split by one factor, and which numbers go left; categories go by their ratio."""
    g, h, n = sums
    if not ordered:
        ratio = np.divide(g, h, out=np.full(g.shape, np.inf), where=n > 0)
        order = np.argsort(ratio, axis=1, kind="stable")
        g, h, n = (np.take_along_axis(x, order, axis=1) for x in (g, h, n))
    left_g, left_h, left_n = (np.cumsum(x, axis=1) for x in (g, h, n))
    total_g, total_h, total_n = left_g[:, -1:], left_h[:, -1:], left_n[:, -1:]
    right_g, right_h = total_g - left_g, total_h - left_h
    fits = (left_h >= least) & (right_h >= least) & (left_n > 0) & (left_n < total_n)
    right_h = np.where(fits, right_h, 1.0)
    gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - total_g**2 / (total_h + penalty)
    gain = np.where(fits, gain, -np.inf)
    best = gain.argmax(axis=1)
    goes = np.arange(g.shape[1]) <= best[:, None]
    if not ordered:
        placed = np.zeros_like(goes)
        np.put_along_axis(placed, order, goes & (n > 0), axis=1)
        goes = placed
    return gain[np.arange(len(best)), best], goes


def grow(sums: Sums, grid: Grid, depth: int, penalty: float, least: float, gain: float) -> Tree:
    """A tree with the sums of its nodes.

    A split must gain more than `gain` and leave a curvature of `least` on both
    sides. Of two equal gains the first factor and the lowest cut win.
    """
    tree = Tree.of_depth(depth, max(grid.sizes))
    starts, nodes = grid.starts, [1]
    level = sums(tree, nodes)
    tree.sums[:, 1] = level[:, 0, : starts[1]].sum(axis=1)
    for left_over in reversed(range(depth)):
        found = [
            _best_splits(level[:, :, a:b], cuts is not None, penalty, least) for a, b, cuts in zip(starts, starts[1:], grid.cuts)
        ]
        gains = np.array([f[0] for f in found])
        best = gains.argmax(axis=0)
        split = [i for i in range(len(nodes)) if gains[best[i], i] > gain]
        if not split:
            break
        for i in split:
            factor, node = int(best[i]), nodes[i]
            goes = found[factor][1][i]
            part = level[:, i, starts[factor] : starts[factor + 1]]
            tree.factor[node], tree.goes[node, : len(goes)] = factor, goes
            tree.sums[:, 2 * node], tree.sums[:, 2 * node + 1] = part[:, goes].sum(axis=1), part[:, ~goes].sum(axis=1)
        if not left_over:
            break
        parents = [nodes[i] for i in split]
        small = [2 * p + int(tree.sums[2, 2 * p + 1] < tree.sums[2, 2 * p]) for p in parents]
        counted = sums(tree, small)
        rest = level[:, split] - counted
        # What is left of a number without rows is rounding.
        rest = np.where(np.rint(rest[2]) > 0, rest, 0.0)
        nodes = sorted([*small, *(s ^ 1 for s in small)])
        level = np.zeros((3, len(nodes), level.shape[2]))
        for k, s in enumerate(small):
            level[:, nodes.index(s)], level[:, nodes.index(s ^ 1)] = counted[:, k], rest[:, k]
    return tree
