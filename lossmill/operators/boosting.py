"""Boosted trees for counts, severities and trigger probabilities.

Each round is a Newton step: a tree is grown on sums of gradient and curvature, and
its leaves are the regularized step. Training runs on rating cells, one row per
combination of rating factors, holding sums over the policies of the cell. Gradients
depend on a policy only through those sums, so this gives the trees of the policy
rows; the cells are as many as combinations occur, which for a portfolio much larger
than its tariff is the size of the tariff.

Few cells are trained on in one task, which returns the trees of many rounds at once.
Otherwise the cells lie as arrays in a persisted RDD for the whole training, several factors in one
code, and a level of a tree is a short job over it that sends back nothing but histograms,
whose size depends on the tree and the factors. Trees are rows, from which a training that
was interrupted goes on.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..params import CATEGORY_FACTORS, RATING_FACTORS
from ..session import shared_folder, ship
from .trees import MASK_BITS, QUICK, Grid, Reached, TaskSums, Tree, code_sums, grouped, grow, leaf_place, paired

MISSING_NUMBER = -1.0  # below every rating factor; lets a split single out unknown values
MISSING_CATEGORY = ""
TINY = 1e-16
MARGIN_LIMIT = 60.0  # keeps exp() finite

# Fixed values of the Poisson objective: the largest step of a leaf, which also
# enters the curvature as exp(margin + limit).
POISSON_STEP_LIMIT = 0.7

#: Cells up to which one task trains alone (about 100 bytes each): a job for each level of
#: a tree costs more than the sums of so many cells.
CELLS_ALONE = 1_000_000
#: Beyond that, cells that one task is meant for, and those that are worth a task of their own.
CELLS_PER_TASK, LEAST_CELLS = 1_000_000, 250_000

#: Bins of several factors together up to which scoring looks them up as one: a round's tables stay in the cache.
MOST_BINS = 1 << 12

#: Rounds between two written states of the margins.
ROUNDS_PER_TABLE = 10

#: A tree as rows. Nodes of a round are numbered from 1, the children of n are 2n and
#: 2n + 1; a row goes left if its value is at most `cut` or among `left`. A leaf has
#: no factor but a step. Round 0 has one leaf, the margin before the first tree.
NODES = "round int, node int, factor string, cut double, left array<string>, step double"


@dataclass(frozen=True)
class Boosting:
    """Training length and tree shape. The defaults are fixed values."""

    rounds: int
    depth: int = 6
    rate: float = 0.3
    penalty: float = 1.0  # added to the curvature of a leaf
    leaf_curvature: float = 1.0  # smallest curvature a leaf may hold
    gain: float = 1e-9  # smallest gain of a split; less is rounding noise
    bins: int | None = 256  # values of a number between which all splits are tried; None: no limit
    rounds_per_job: int = 50  # rounds between two stored states


FREQUENCY = Boosting(rounds=150, depth=5, rate=0.05)
SEVERITY = Boosting(rounds=120, depth=5, rate=0.05)
TRIGGER = Boosting(rounds=100, depth=6, rate=0.05)
AUDIT = Boosting(rounds=50)


@dataclass(frozen=True)
class Objective:
    """Gradient and curvature of a cell from its two sums and its margin.

    ``base`` is the margin before the first tree. An exposure offset is part of
    the cell's sums, since it enters as a factor of the expected count. The
    formulas hold for columns and, with NumPy's ``exp``, for arrays.
    """

    gradients: Callable
    base: float = 0.0
    step_limit: float | None = None


def poisson(base: float = 0.0) -> Objective:
    """``target``: sum of counts; ``volume``: sum of exposures (or of rows)."""

    def gradients(target, volume, margin, exp=F.exp):
        expected = volume * exp(margin)
        return expected - target, expected * math.exp(POISSON_STEP_LIMIT)

    return Objective(gradients, base, POISSON_STEP_LIMIT)


def gamma(base: float) -> Objective:
    """``target``: sum of severities; ``volume``: number of severities."""

    def gradients(target, volume, margin, exp=F.exp):
        scaled = target * exp(-margin)
        return volume - scaled, scaled

    return Objective(gradients, base)


def logistic(base: float = 0.0) -> Objective:
    """``target``: weight of the positives; ``volume``: weight of all rows."""

    def gradients(target, volume, margin, exp=F.exp):
        chance = 1.0 / (exp(-margin) + 1.0)
        return volume * chance - target, volume * chance * (1.0 - chance)

    return Objective(gradients, base)


def probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.exp(-margin) + 1.0)


def filled_factors() -> list[Column]:
    """The rating factors as the models see them: no NULL, numbers as doubles."""
    return [
        F.coalesce(F.col(name), F.lit(MISSING_CATEGORY)).alias(name)
        if name in CATEGORY_FACTORS
        else F.coalesce(F.col(name).cast("double"), F.lit(MISSING_NUMBER)).alias(name)
        for name in RATING_FACTORS
    ]


def places(column: pa.Array, names: tuple[str, ...] | list[str]) -> np.ndarray:
    """Place of each category among the names; one beyond the last for any other."""
    found = pc.index_in(column, value_set=pa.array(names, pa.string()))
    return np.asarray(pc.fill_null(found, len(names)))


@dataclass
class BoostedTrees:
    """Trees as rows of `NODES`, and their margins for any policies."""

    rows: list[tuple] = field(default_factory=list)

    def __post_init__(self):
        rounds = max((r[0] for r in self.rows), default=0) + 1
        heap = max((r[1] for r in self.rows), default=1) + 1
        self.depth = heap.bit_length() - 1
        self.names = [sorted({x for r in self.rows if r[2] == name for x in r[4] or ()}) for name in RATING_FACTORS]
        self.factor = np.full((rounds, heap), -1)
        self.cut = np.full((rounds, heap), -np.inf)
        self.left = np.zeros((rounds, heap, max(map(len, self.names)) + 1), dtype=bool)
        self.step = np.zeros((rounds, heap))
        for turn, node, factor, cut, left, step in self.rows:
            if factor is None:
                self.step[turn, node] = step
                continue
            number = RATING_FACTORS.index(factor)
            self.factor[turn, node] = number
            if factor in CATEGORY_FACTORS:
                self.left[turn, node, [self.names[number].index(x) for x in left]] = True
            else:
                self.cut[turn, node] = cut

    @property
    def rounds(self) -> int:
        return max((r[0] for r in self.rows), default=0)

    def codes(self, columns: list) -> np.ndarray:
        """Values of Arrow columns in the order of the rating factors (see `filled_factors`)."""
        found = [
            places(c, names) if name in CATEGORY_FACTORS else c.to_numpy()
            for name, names, c in zip(RATING_FACTORS, self.names, columns)
        ]
        return np.array(found, dtype=np.float64)

    @cached_property
    def _masks(self) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray] | None:
        """Cuts of each factor; per factor, round and bin the leaves that the bin leaves open, as bits; the steps.

        The only leaf that all factors leave open is the one that is reached, so no
        row has to walk down a tree. None where a tree has too many leaves for that.
        """
        cuts = [np.unique(self.cut[self.factor == f]) for f in range(len(RATING_FACTORS))]
        sizes = [len(n if name in CATEGORY_FACTORS else c) + 1 for name, n, c in zip(RATING_FACTORS, self.names, cuts)]
        every = (1 << MASK_BITS) - 1
        masks = [np.full((len(self.factor), size), every, dtype=np.uint64) for size in sizes]
        # A power of two as a double has its place in the exponent (see `leaf_place`).
        steps = np.zeros((len(self.factor), 1023 + MASK_BITS))

        def leaves(turn: int, node: int, first: int) -> int:
            """Number the leaves below a node from `first`; the number after the last."""
            number = self.factor[turn, node]
            if number < 0:
                if first < MASK_BITS:
                    steps[turn, 1023 + first] = self.step[turn, node]
                return first + 1
            middle = leaves(turn, 2 * node, first)
            last = leaves(turn, 2 * node + 1, middle)
            if RATING_FACTORS[number] in CATEGORY_FACTORS:
                goes = self.left[turn, node, : sizes[number]]
            else:
                goes = np.arange(sizes[number]) <= np.searchsorted(cuts[number], self.cut[turn, node])
            lower, upper = ((1 << middle) - (1 << first)) & every, ((1 << last) - (1 << middle)) & every
            masks[number][turn] &= np.where(goes, np.uint64(every ^ upper), np.uint64(every ^ lower))
            return last

        ends = [leaves(turn, 1, 0) for turn in range(len(self.factor))]
        for turn, end in enumerate(ends):
            masks[0][turn] &= np.uint64((1 << min(end, MASK_BITS)) - 1)
        return (cuts, masks, steps) if max(ends) <= MASK_BITS else None

    @cached_property
    def _grouped(self) -> tuple[list[list[int]], list[np.ndarray]]:
        """Factors whose bins are looked up as one, and the leaves that these leave open."""
        masks = self._masks[1]
        groups, tables = grouped(tuple(m.shape[1] for m in masks), MOST_BINS), []
        for group in groups:
            table = masks[group[0]]
            for f in group[1:]:
                table = (table[:, :, None] & masks[f][:, None, :]).reshape(len(table), -1)
            tables.append(table)
        return groups, tables

    def bins(self, codes: np.ndarray) -> list[np.ndarray]:
        """Per factor the place of each code among the cuts or names of the trees."""
        found = zip(RATING_FACTORS, self._masks[0], codes)
        return [x.astype(np.int64) if name in CATEGORY_FACTORS else np.searchsorted(cuts, x) for name, cuts, x in found]

    def margins(self, codes: np.ndarray) -> np.ndarray:
        """Margins of rows given by their codes, one row per factor."""
        if self._masks is None:
            return self._walked(codes)
        bins, total = self.bins(codes), np.zeros(codes.shape[1])
        groups, tables = self._grouped
        own = [np.ravel_multi_index([bins[f] for f in group], [self._masks[1][f].shape[1] for f in group]) for group in groups]
        for turn, step in enumerate(self._masks[2]):
            open_ = tables[0][turn].take(own[0], mode=QUICK)
            for table, places_ in zip(tables[1:], own[1:]):
                open_ &= table[turn].take(places_, mode=QUICK)
            total += step.take(leaf_place(open_), mode=QUICK)
        return total

    def exchanged(self, codes: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
        """Factor, number of the other codes and margins of the rows `codes[0]` with that factor taken from the others."""
        if self._masks is None:
            for factor in range(len(RATING_FACTORS)):
                for other in range(1, len(codes)):
                    mixed = codes[0].copy()
                    mixed[factor] = codes[other][factor]
                    yield factor, other, self._walked(mixed)
            return
        _, masks, steps = self._masks
        bins = [self.bins(x) for x in codes]
        total = np.zeros((len(RATING_FACTORS), len(codes), codes[0].shape[1]))
        for turn, step in enumerate(steps):
            own = [mask[turn][places_] for mask, places_ in zip(masks, bins[0])]
            for factor, mask in enumerate(masks):
                others = np.bitwise_and.reduce([x for f, x in enumerate(own) if f != factor])
                for other in range(1, len(codes)):
                    total[factor, other] += step[leaf_place(others & mask[turn][bins[other][factor]])]
        for factor in range(len(RATING_FACTORS)):
            for other in range(1, len(codes)):
                yield factor, other, total[factor, other]

    def _walked(self, codes: np.ndarray) -> np.ndarray:
        category = np.isin(RATING_FACTORS, CATEGORY_FACTORS)
        total, row = np.zeros(codes.shape[1]), np.arange(codes.shape[1])
        for factor, cut, left, step in zip(self.factor, self.cut, self.left, self.step):
            node = np.ones(len(row), dtype=np.int64)
            while True:
                asked = factor[node]
                if (asked < 0).all():
                    break
                value = codes[asked, row]
                of_name = category[asked] & (asked >= 0)
                goes = np.where(of_name, left[node, np.where(of_name, value, 0).astype(np.int64)], value <= cut[node])
                node = np.where(asked < 0, node, 2 * node + 1 - goes)
            total += step[node]
        return total

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, NODES)


def margins(policies: DataFrame, models: dict[str, BoostedTrees]) -> DataFrame:
    """Add a margin column per model to any frame with the rating factors; a map over its rows.

    The trees go to the executors, some hundred nodes per round.
    """
    ship(policies.sparkSession)
    factors = [f"_{name}" for name in RATING_FACTORS]
    coded = policies.select("*", *[c.alias(n) for c, n in zip(filled_factors(), factors)])
    added = [T.StructField(name, T.DoubleType()) for name in models]
    schema = T.StructType([*policies.schema.fields, *added])
    return coded.mapInArrow(partial(_with_margins, models=models, factors=factors), schema)


def _with_margins(batches: Iterator[pa.RecordBatch], models: dict, factors: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [c for c in batch.schema.names if c not in factors]
        values = [batch[c] for c in factors]
        found = [pa.array(model.margins(model.codes(values))) for model in models.values()]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *found], [*kept, *models])


def fitted_grid(cells: DataFrame, params: Boosting) -> Grid:
    return Grid.fit(cells, RATING_FACTORS, CATEGORY_FACTORS, params.bins)


def boost(
    cells: DataFrame,
    objective: Objective,
    params: Boosting,
    target: str,
    volume: str,
    saved: BoostedTrees | None = None,
    save: Callable[[DataFrame], object] = lambda rows: None,
    tasks: int | None = None,
    grid: Grid | None = None,
) -> BoostedTrees:
    """Fit on the cells, which have the rating factors without NULLs.

    `grid`: that of the cells, where it is known already (see `fitted_grid`).
    Goes on from `saved` rounds and hands the rows of every `rounds_per_job` rounds to
    `save`. Cells are dealt out by their factors and ordered within a task, so that a
    repeated task gives the same sums.
    """
    spark = cells.sparkSession
    grid = grid or fitted_grid(cells, params)
    model = saved or BoostedTrees([(0, 1, None, None, None, float(objective.base))])
    if not saved:
        save(model.frame(spark))
    ship(spark)
    # A cell without volume has no part in any sum.
    cells = cells.select(*RATING_FACTORS, target, volume).where(F.col(volume) > 0)
    tasks = tasks or _tasks(spark, cells.count())
    cells = cells.repartition(tasks, *RATING_FACTORS)
    train = _train_alone if tasks == 1 else _train_by_levels
    for rows in train(cells, grid, objective, params, model):
        save(spark.createDataFrame(rows, NODES))
        model = BoostedTrees(model.rows + rows)
    return model


def _tasks(spark: SparkSession, cells: int) -> int:
    if cells <= CELLS_ALONE:
        return 1
    return max(math.ceil(cells / CELLS_PER_TASK), min(math.ceil(cells / LEAST_CELLS), spark.sparkContext.defaultParallelism))


@dataclass
class Block:
    """Cells of a task: numbers of their factors (or their codes, see `Grid.codes`), sums and margins."""

    numbers: np.ndarray | list[np.ndarray]
    target: np.ndarray
    volume: np.ndarray
    margin: np.ndarray

    def graded(self, objective: Objective) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature at the current margin."""
        bounded = np.clip(self.margin, -MARGIN_LIMIT, MARGIN_LIMIT)
        gradient, curvature = objective.gradients(self.target, self.volume, bounded, np.exp)
        present = self.volume > 0
        if present.all():
            return gradient, np.maximum(curvature, TINY)
        return np.where(present, gradient, 0.0), np.where(present, np.maximum(curvature, TINY), 0.0)

    def graded_rows(self, row: np.ndarray, objective: Objective) -> tuple[np.ndarray, np.ndarray]:
        return Block([], *(x.take(row, mode=QUICK) for x in (self.target, self.volume, self.margin))).graded(objective)

    def moved(self, rows: dict[int, np.ndarray], steps: np.ndarray) -> Block:
        """The cells after one more tree, given the rows of its leaves."""
        margin = self.margin.copy()
        for node, row in rows.items():
            margin[row] += steps[node]
        return Block(self.numbers, self.target, self.volume, margin)


def _block(batches: Iterable[pa.RecordBatch], grid: Grid, model: BoostedTrees) -> Block:
    """All cells of a task in order of their factors, as far as the model is trained."""
    width, held = len(RATING_FACTORS), [pa.table(batch) for batch in batches]
    if not held:
        return Block(np.zeros((width, 0), dtype=np.int64), *[np.zeros(0)] * 3)
    columns = [c.combine_chunks() for c in pa.concat_tables(held).columns]
    values = [
        c.to_numpy(zero_copy_only=False) if labels is None else places(c, labels)
        for c, labels in zip(columns[:width], grid.labels)
    ]
    # The names of a category are in order, so their places sort like them.
    order = np.lexsort(values[::-1])
    target, volume = (c.to_numpy(zero_copy_only=False).astype(np.float64).take(order) for c in columns[width:])
    numbers = grid.numbers(values).astype(np.min_scalar_type(max(grid.sizes))).take(order, axis=1)
    return Block(numbers, target, volume, model.margins(model.codes(columns[:width])).take(order))


def _grown(sums: Callable, grid: Grid, params: Boosting) -> Tree:
    return grow(sums, grid, params.depth, params.penalty, params.leaf_curvature, params.gain)


def _train(
    batches: Iterator[pa.RecordBatch], grid: Grid, objective: Objective, params: Boosting, model: BoostedTrees, upto: int
) -> Iterator[pa.RecordBatch]:
    """The rounds of one job on the cells of its one task."""
    block, rows = _block(batches, grid, model), []
    pairs = paired(block.numbers, grid)
    for turn in range(model.rounds + 1, upto + 1):
        sums = TaskSums(block.numbers, grid, *block.graded(objective), pairs)
        tree = _grown(sums, grid, params)
        if tree.sums[1, 1] <= 0:
            break
        steps = _steps(tree, objective, params)
        sums.descend(tree)
        block = block.moved(sums.rows, steps)
        rows += node_rows(turn, tree, steps, grid)
    if rows:
        names = [c.split()[0] for c in NODES.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names)


def _train_alone(cells: DataFrame, grid: Grid, objective: Objective, params: Boosting, model: BoostedTrees) -> Iterator[list[tuple]]:
    """Rows of every `rounds_per_job` rounds, trained by one task."""
    while model.rounds < params.rounds:
        upto = min(params.rounds, model.rounds + params.rounds_per_job)
        train = partial(_train, grid=grid, objective=objective, params=params, model=model, upto=upto)
        rows = [tuple(r) for r in cells.mapInArrow(train, NODES).collect()]
        if not rows:
            return  # no cell to learn from
        yield rows
        model = BoostedTrees(model.rows + rows)


def _train_by_levels(cells: DataFrame, grid: Grid, objective: Objective, params: Boosting, model: BoostedTrees) -> Iterator[list[tuple]]:
    """The same rounds, every level of a tree a job over blocks that are held as arrays."""
    context = cells.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(cells.sparkSession))
    packed = cells.mapInArrow(partial(_packed, grid=grid, model=model), "block binary")
    state = packed.rdd.map(_unpacked).persist(StorageLevel.MEMORY_AND_DISK)
    rows, before = [], []
    for turn in range(model.rounds + 1, params.rounds + 1):
        if turn % ROUNDS_PER_TABLE == 0:
            state.checkpoint()
        tree = _grown(_level_sums(state, grid, objective), grid, params)
        for old in before:
            old.unpersist()
        before = [state]
        if tree.sums[1, 1] <= 0:
            break
        steps = _steps(tree, objective, params)
        rows += node_rows(turn, tree, steps, grid)
        if (turn - model.rounds) % params.rounds_per_job == 0:
            yield rows
            rows = []
        state = state.map(partial(_moved, grid=grid, tree=tree, steps=steps)).persist(StorageLevel.MEMORY_AND_DISK)
    for old in before:
        old.unpersist()
    if rows:
        yield rows


def _packed(batches: Iterator[pa.RecordBatch], grid: Grid, model: BoostedTrees) -> Iterator[pa.RecordBatch]:
    block = _block(batches, grid, model)
    there = np.flatnonzero(block.volume > 0)
    block = Block(grid.codes(block.numbers.take(there, axis=1)), *(x.take(there) for x in (block.target, block.volume, block.margin)))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, pickle.HIGHEST_PROTOCOL)], pa.binary())], ["block"])


def _unpacked(row: tuple) -> Block:
    return pickle.loads(row[0])


def _moved(block: Block, grid: Grid, tree: Tree, steps: np.ndarray) -> Block:
    """The cells after one more tree."""
    margin = block.margin.copy()
    for part in Reached.in_parts(grid, tree, tree.ends()):
        for row, place in part.pieces(block.numbers):
            margin[row] += steps[part.nodes].take(place)
    return Block(block.numbers, block.target, block.volume, margin)


def _level_sums(state: RDD, grid: Grid, objective: Objective) -> Callable:
    """Sums over all blocks; a job for each level of a tree."""

    def sums(tree: Tree, nodes: list[int]) -> np.ndarray:
        found = state.map(partial(_own_sums, grid=grid, objective=objective, tree=tree, nodes=nodes)).collect()
        return sum(found[1:], found[0])

    return sums


def _own_sums(block: Block, grid: Grid, objective: Objective, tree: Tree, nodes: list[int]) -> np.ndarray:
    return code_sums(block.numbers, grid, partial(block.graded_rows, objective=objective), tree, nodes)


def node_rows(turn: int, tree: Tree, steps: np.ndarray, grid: Grid) -> list[tuple]:
    """A tree as rows of `NODES`."""
    rows, nodes = [], [1]
    while nodes:
        node = nodes.pop()
        factor = int(tree.factor[node])
        if factor < 0:
            rows.append((turn, node, None, None, None, float(steps[node])))
            continue
        goes = np.flatnonzero(tree.goes[node, : grid.sizes[factor]])
        labels, cuts = grid.labels[factor], grid.cuts[factor]
        left = [labels[i] for i in goes if i < len(labels)] if labels is not None else None
        cut = float(cuts[goes[-1]]) if cuts is not None else None
        rows.append((turn, node, RATING_FACTORS[factor], cut, left, None))
        nodes += [2 * node + 1, 2 * node]
    return rows


def _steps(tree: Tree, objective: Objective, params: Boosting) -> np.ndarray:
    """Step per node: regularized Newton step, limited, times the rate."""
    step = -tree.sums[0] / (tree.sums[1] + params.penalty)
    if objective.step_limit is not None:
        step = np.clip(step, -objective.step_limit, objective.step_limit)
    return params.rate * step
