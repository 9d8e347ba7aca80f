import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lossmill import session
from lossmill.operators import boosting as bt
from lossmill.operators import insights, trees

N = 600


@pytest.fixture(scope="module")
def policies(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame(
        {
            "IDpol": np.arange(N),
            "Exposure": rng.integers(1, 13, N) / 12,
            "Area": rng.choice(["A", "B", None], N),
            "Region": rng.choice(["R1", "R2", "R3"], N),
            "VehPower": rng.integers(4, 7, N),
            "VehAge": rng.integers(0, 3, N),
            "DrivAge": rng.integers(20, 23, N),
            "BonusMalus": rng.integers(50, 52, N),
        }
    )
    rate = np.exp(-0.3 + 0.9 * (pdf.Region == "R2") - 0.5 * (pdf.VehPower == 6))
    pdf["ReportedClaimCount"] = rng.poisson(rate * pdf.Exposure)
    cost = rng.gamma(2.0, np.exp(6 + 0.6 * (pdf.Area == "B")) / 2.0)
    pdf["UltimateLosses"] = np.where(pdf.ReportedClaimCount > 0, cost, 0.0)
    pdf["EarnedPremium"] = 300.0 * pdf.Exposure
    frame = spark.createDataFrame(pdf.drop(columns=["DrivAge"])).withColumn(
        "DrivAge", F.when(F.col("IDpol") % 50 > 0, F.col("IDpol") % 3 + 20)
    )
    return frame


@pytest.fixture(scope="module")
def prepared(policies):
    return insights.rating_cells(policies)


def short(params, rounds, depth=None, rate=None, every=2):
    params = replace(params, rounds=rounds, rounds_per_job=every)
    if depth:
        params = replace(params, depth=depth)
    return replace(params, rate=rate) if rate else params


def margins_of(model, frame):
    """Margins of a frame's rows, in the order of toPandas()."""
    return bt.margins(frame, {"m": model}).toPandas().m.to_numpy()


def rows_as_cells(prepared):
    """One cell per policy: the same sums without grouping."""
    known = (F.col("ReportedClaimCount") > 0) & (F.col("UltimateLosses") > 0)
    severity = F.col("UltimateLosses") / F.col("ReportedClaimCount").cast("double")
    return prepared.policies.select(
        "IDpol",
        *bt.filled_factors(),
        F.col("Exposure").alias("exposure"),
        F.col("ReportedClaimCount").cast("double").alias("claims"),
        known.cast("double").alias("severities"),
        F.when(known, severity).otherwise(0.0).alias("severity"),
        F.lit(1.0).alias("policies"),
        F.col("Is_Large_Loss").cast("double").alias("large"),
    )


def test_cells_hold_the_portfolio(prepared, policies):
    cells = prepared.cells.toPandas()
    pdf = policies.toPandas()
    assert len(cells) < N and cells.policies.sum() == N
    assert cells.exposure.sum() == pytest.approx(pdf.Exposure.sum())
    assert cells.claims.sum() == pdf.ReportedClaimCount.sum()
    claims = pdf[pdf.ReportedClaimCount > 0]
    assert cells.severities.sum() == len(claims)
    severity = claims.UltimateLosses / claims.ReportedClaimCount
    assert cells.severity.sum() == pytest.approx(severity.sum())
    assert cells.large.sum() == (severity > severity.quantile(0.95)).sum()


def test_first_step_is_the_regularized_newton_step(prepared):
    """Leaves of the first tree against sums formed by hand."""
    params = short(bt.FREQUENCY, 1, depth=2, rate=1.0)
    model = insights.fit_frequency(prepared.cells, params)
    cells = bt.margins(prepared.cells, {"m": model}).toPandas()
    assert cells.m.nunique() > 1
    for margin, leaf in cells.groupby("m"):
        g = (leaf.exposure - leaf.claims).sum()
        h = leaf.exposure.sum() * math.exp(0.7)
        assert margin == pytest.approx(max(-0.7, min(0.7, -g / (h + 1.0))))


def test_gradients_match_finite_differences(spark):
    """Gradient and curvature of the three losses against their definitions."""
    margin, target, volume = 0.3, 2.0, 5.0
    losses = {
        bt.poisson: lambda f: volume * math.exp(f) - target * f,
        bt.gamma: lambda f: target * math.exp(-f) + volume * f,
        bt.logistic: lambda f: volume * math.log(1 + math.exp(f)) - target * f,
    }
    row = spark.range(1)
    for build, loss in losses.items():
        g, h = build(0.0).gradients(F.lit(target), F.lit(volume), F.lit(margin))
        found_g, found_h = row.select(g, h).first()
        e = 1e-4
        assert found_g == pytest.approx((loss(margin + e) - loss(margin - e)) / (2 * e), rel=1e-5)
        second = (loss(margin + e) - 2 * loss(margin) + loss(margin - e)) / e**2
        inflated = math.exp(0.7) if build is bt.poisson else 1.0
        assert found_h == pytest.approx(second * inflated, rel=1e-4)


FITS = [insights.fit_frequency, insights.fit_severity, insights.fit_trigger]


def by_structure(rows):
    return {r[:2]: (r[2], r[3], tuple(r[4] or ())) for r in rows}


@pytest.mark.parametrize("fit", FITS)
def test_cells_and_rows_give_one_model(prepared, fit):
    params = short(bt.Boosting(rounds=3), 3, depth=3, rate=0.3)
    by_cell, by_row = fit(prepared.cells, params), fit(rows_as_cells(prepared).repartition(5), params)
    assert by_structure(by_cell.rows) == by_structure(by_row.rows)
    assert np.allclose(margins_of(by_cell, prepared.policies), margins_of(by_row, prepared.policies), rtol=1e-8)


@pytest.mark.parametrize("fit", FITS)
def test_one_job_and_a_job_per_level_give_one_model(prepared, fit, monkeypatch):
    """Histograms exchanged by the tasks of a job against those aggregated by Spark."""
    params = short(bt.Boosting(rounds=3), 3, depth=3, rate=0.2, every=2)
    together = [fit(prepared.cells, params, tasks=n) for n in (1, 3)]
    monkeypatch.setattr(bt, "ROUNDS_PER_TABLE", 2)
    context = prepared.cells.sparkSession.sparkContext
    conf = context.getConf().set("spark.dynamicAllocation.enabled", "true")
    monkeypatch.setattr(type(context), "getConf", lambda self: conf)
    apart = fit(prepared.cells, params)
    for model in together:
        assert by_structure(model.rows) == by_structure(apart.rows)
        assert np.allclose(margins_of(model, prepared.policies), margins_of(apart, prepared.policies), rtol=1e-9)


def test_training_goes_on_from_stored_rounds(prepared):
    whole, stored = insights.fit_frequency(prepared.cells, short(bt.FREQUENCY, 5)), []
    insights.fit_frequency(prepared.cells, short(bt.FREQUENCY, 2), save=lambda rows: stored.extend(map(tuple, rows.collect())))
    assert {r[0] for r in stored} == {0, 1, 2}
    later = []
    resumed = insights.fit_frequency(
        prepared.cells, short(bt.FREQUENCY, 5), saved=bt.BoostedTrees(stored), save=lambda rows: later.extend(map(tuple, rows.collect()))
    )
    assert {r[0] for r in later} == {3, 4, 5}
    assert by_structure(resumed.rows) == by_structure(whole.rows)
    assert np.allclose(margins_of(resumed, prepared.policies), margins_of(whole, prepared.policies), rtol=1e-9)


STEP = """SELECT w.IDpol, w.round, CASE WHEN n.factor IS NULL THEN w.node ELSE 2 * w.node + CASE n.factor
    WHEN 'Area' THEN CAST(NOT list_contains(n."left", coalesce(w.Area, '')) AS INT)
    WHEN 'Region' THEN CAST(NOT list_contains(n."left", coalesce(w.Region, '')) AS INT)
    WHEN 'VehPower' THEN CAST(coalesce(w.VehPower, -1) > n.cut AS INT)
    WHEN 'VehAge' THEN CAST(coalesce(w.VehAge, -1) > n.cut AS INT)
    WHEN 'DrivAge' THEN CAST(coalesce(w.DrivAge, -1) > n.cut AS INT)
    ELSE CAST(coalesce(w.BonusMalus, -1) > n.cut AS INT) END END AS node,
    w.Area, w.Region, w.VehPower, w.VehAge, w.DrivAge, w.BonusMalus
FROM walk{0} w JOIN nodes n ON w.round = n.round AND w.node = n.node"""


def test_sql_repeats_the_margins_from_the_node_rows(spark, prepared):
    import duckdb

    model = insights.fit_frequency(prepared.cells, short(bt.FREQUENCY, 6, depth=4))
    unseen = prepared.policies.withColumns({"Region": F.lit("elsewhere"), "VehAge": F.col("VehAge") + 7, "IDpol": F.col("IDpol") + N})
    frame = prepared.policies.unionByName(unseen)
    found = bt.margins(frame, {"m": model}).toPandas()
    nodes, policies = model.frame(spark).toPandas(), frame.toPandas()  # noqa: F841
    walk = "walk0 AS (SELECT IDpol, r AS round, 1 AS node, Area, Region, VehPower, VehAge, DrivAge, BonusMalus FROM policies CROSS JOIN (SELECT DISTINCT round AS r FROM nodes))"
    walks = ", ".join([walk, *(f"walk{d + 1} AS ({STEP.format(d)})" for d in range(4))])
    sql = f"WITH {walks} SELECT IDpol, sum(n.step) AS m FROM walk4 w JOIN nodes n ON w.round = n.round AND w.node = n.node GROUP BY IDpol"
    want = duckdb.sql(sql).df().set_index("IDpol").m
    assert len(want) == len(found) == 2 * N
    assert np.allclose(found.m, want.loc[found.IDpol], rtol=1e-12)


def test_no_jump_where_a_number_has_more_values_than_bins(spark):
    """The same rows with 256 and with 257 values, all cuts allowed: splits stay where they were."""
    rng = np.random.default_rng(4)
    for values in (256, 257):
        age = np.repeat(np.arange(values), 6)
        pdf = pd.DataFrame({"DrivAge": age.astype(float), "claims": rng.poisson(0.5 + 2.0 * (age >= 100)).astype(float), "n": 1.0})
        for name in ("VehPower", "VehAge", "BonusMalus"):
            pdf[name] = 1.0
        pdf["Area"] = pdf["Region"] = "A"
        model = bt.boost(spark.createDataFrame(pdf), bt.poisson(), bt.Boosting(rounds=1, depth=1, bins=None), "claims", "n")
        (root,) = [r for r in model.rows if r[2]]
        assert root[2:4] == ("DrivAge", 99.5)


def loss_after(prepared, rounds):
    model = insights.fit_frequency(prepared.cells, short(bt.FREQUENCY, rounds))
    pdf = bt.margins(prepared.cells, {"m": model}).toPandas()
    return (pdf.exposure * np.exp(pdf.m) - pdf.claims * pdf.m).sum()


def test_loss_falls_with_the_rounds(prepared):
    losses = [loss_after(prepared, rounds) for rounds in (1, 3, 5)]
    assert losses[0] > losses[1] > losses[2]


def test_insights_cover_every_policy(policies):
    params = [short(p, 2) for p in (bt.FREQUENCY, bt.SEVERITY, bt.TRIGGER)]
    result = insights.underwriting_insights(policies, *params)
    pdf = result.toPandas()
    assert tuple(result.columns) == insights.INSIGHT_COLUMNS
    assert sorted(pdf.IDpol) == list(range(N))
    assert pdf.notna().all().all()
    assert (pdf.Pred_Frequency_Count > 0).all() and (pdf.Pred_Severity_Cost > 0).all()
    assert pdf.XoL_Trigger_Probability.between(0, 1).all()
    premium = policies.select("IDpol", "EarnedPremium").toPandas().set_index("IDpol").EarnedPremium
    expected = pdf.Pred_Frequency_Count * pdf.Pred_Severity_Cost
    assert np.allclose(pdf.Expected_Pure_Premium, expected)
    assert np.allclose(pdf.Technical_Loss_Ratio, expected / premium.loc[pdf.IDpol].to_numpy() * 100)
    checks = insights.insight_validation(result).first()
    assert checks["Avg_Technical_LR"] == pytest.approx(pdf.Technical_Loss_Ratio.mean())
    assert checks["High_Risk_Policies"] == (pdf.Technical_Loss_Ratio > 150).sum()


def test_a_portfolio_without_claims_keeps_its_starting_margins(policies):
    empty = policies.withColumns(
        {"ReportedClaimCount": F.lit(0).cast("long"), "UltimateLosses": F.lit(0.0)}
    )
    result = insights.underwriting_insights(empty, *[short(bt.FREQUENCY, 1)] * 3).toPandas()
    assert len(result) == N
    assert (result.Is_Large_Loss == 0).all()
    assert (result.Pred_Severity_Cost == 1.0).all()


def test_a_tree_finds_the_best_split(spark):
    """Depth one against all splits tried by hand; 300 categories are no limit."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 300, 3000).astype(float), "b": rng.integers(0, 9, 3000).astype(float)})
    pdf["_gradient"], pdf["_curvature"] = rng.normal(size=3000) + (pdf.a % 7 == 3), rng.uniform(0.5, 2, 3000)
    pdf["a"] = "c" + pdf.a.astype(int).astype(str)
    rows = spark.createDataFrame(pdf)
    grid = trees.Grid.fit(rows, ("a", "b"), ("a",), 256)
    tree = trees.grow(trees.frame_sums(rows.withColumn("_bins", grid.column()), grid), grid, 1, 1.0, 1.0, 1e-9)

    def gain(left):
        sums = [(pdf._gradient[m].sum(), pdf._curvature[m].sum()) for m in (left, ~left)]
        return sum(g * g / (h + 1) for g, h in sums)

    by_a = pdf.groupby("a")[["_gradient", "_curvature"]].sum()
    ranked = (by_a._gradient / by_a._curvature).sort_values().index
    best = max([gain(pdf.a.isin(ranked[:i])) for i in range(1, 300)] + [gain(pdf.b <= i) for i in range(8)])
    node = tree.leaves(grid.numbers([pd.Index(grid.labels[0]).get_indexer(pdf.a), pdf.b.to_numpy()]))
    assert gain(pd.Series(node == 2)) == pytest.approx(best)
    assert tree.sums[0, 2:].tolist() == pytest.approx([pdf._gradient[node == i].sum() for i in (2, 3)])


def test_many_values_are_cut_at_percentiles(spark):
    rows = spark.range(5000).select((F.col("id") / 7).alias("x"))
    grid = trees.Grid.fit(rows, ("x",), (), 16)
    assert grid.sizes[0] == 16
    found = rows.withColumn("bins", grid.column()).toPandas()
    numbers = found.bins.map(lambda b: b[0]).to_numpy()
    assert (grid.numbers([found.x.to_numpy()])[0] == numbers).all()
    assert np.bincount(numbers).max() < 2 * 5000 / 16


def test_more_blocks_than_free_cores(spark, prepared):
    """A training whose tasks had to run at once could not begin."""
    params = short(bt.FREQUENCY, 2, depth=3)
    blocks = 3 * spark.sparkContext.defaultParallelism
    apart, alone = (insights.fit_frequency(prepared.cells, params, tasks=n) for n in (blocks, 1))
    assert by_structure(apart.rows) == by_structure(alone.rows)
    assert np.allclose(margins_of(apart, prepared.policies), margins_of(alone, prepared.policies), rtol=1e-9)


@pytest.mark.parametrize("depth", [1, 5, 6, 7])
def test_masks_of_leaves_agree_with_walking_down(depth):
    """Random trees on random codes; 2 ** 7 leaves are too many for a mask."""
    rng = np.random.default_rng(depth)
    rows = [(0, 1, None, None, None, 0.25)]
    for turn in range(1, 5):
        for node in range(1, 2 << depth):
            factor = str(rng.choice(bt.RATING_FACTORS))
            if node >= 1 << depth:
                rows.append((turn, node, None, None, None, float(rng.normal())))
            elif factor in bt.CATEGORY_FACTORS:
                rows.append((turn, node, factor, None, sorted(rng.choice(list("abcdef"), 3, replace=False).tolist()), None))
            else:
                rows.append((turn, node, factor, float(rng.integers(0, 9)), None, None))
    model = bt.BoostedTrees(rows)
    codes = []
    for _ in range(3):
        code = rng.integers(-1, 10, (len(bt.RATING_FACTORS), 500)).astype(float)
        for f, name in enumerate(bt.RATING_FACTORS):
            if name in bt.CATEGORY_FACTORS:
                code[f] = rng.integers(0, len(model.names[f]) + 1, 500)
            else:
                code[f, :3] = np.nan, np.inf, -np.inf
        codes.append(code)
    assert (model._masks is None) == (depth > 6)
    assert (model.margins(codes[0]) == model._walked(codes[0])).all()
    seen = []
    for factor, other, margin in model.exchanged(codes):
        mixed = codes[0].copy()
        mixed[factor] = codes[other][factor]
        assert (margin == model._walked(mixed)).all()
        seen.append((factor, other))
    assert seen == [(f, o) for f in range(len(bt.RATING_FACTORS)) for o in (1, 2)]


@pytest.mark.parametrize("depth", [1, 5, 6, 7])
def test_rows_reach_their_leaves_without_walking_down(depth, monkeypatch):
    rng = np.random.default_rng(depth)
    tree = trees.Tree.of_depth(depth, 9)
    inner = np.arange(1, 1 << depth)
    tree.factor[inner] = rng.integers(0, 3, len(inner))
    tree.factor[inner[-1] // 2 :: 2] = -1
    tree.goes[inner] = rng.random((len(inner), 9)) < 0.5
    numbers = rng.integers(0, 9, (3, 700)).astype(np.uint8)
    walked = np.ones(700, dtype=np.int64)
    for _ in range(depth):
        walked = tree.descend(walked, numbers)
    if len(tree._ends(1)) <= trees.MASK_BITS:
        monkeypatch.setattr(trees.Tree, "descend", None)
    assert (tree.leaves(numbers) == walked).all()


def test_cells_without_volume_go_to_no_task(prepared, monkeypatch):
    """They have no part in a sum; a severity is known for a part of the cells only."""
    counted = []
    monkeypatch.setattr(bt, "_tasks", lambda spark, cells: counted.append(cells) or 1)
    found = insights.fit_severity(prepared.cells, short(bt.SEVERITY, 2, depth=2))
    known = prepared.cells.where("severities > 0")
    assert counted == [known.count()] and known.count() < prepared.cells.count()
    assert found.rows == insights.fit_severity(known, short(bt.SEVERITY, 2, depth=2)).rows


def test_models_side_by_side_send_the_package_once(tmp_path):
    """Three trainings begin at once in a new session; a second file of the same name would fail."""
    sent = []

    class Context:
        applicationId = str(tmp_path)

        def addPyFile(self, path):
            time.sleep(0.2)
            sent.append(path)

    class Session:
        sparkContext = Context()

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(session.ship, [Session()] * 3))
    assert len(sent) == 1


def test_rows_are_divided_by_node_without_another_sum():
    """Sums of a task are those of walking every row down, to the last bit."""
    rng = np.random.default_rng(5)
    grid = trees.Grid(("x", "y", "z"), (("a", "b", "c"), None, None), (None, (0.5, 1.5, 2.5, 3.5), (7.0,)))
    numbers = np.array([rng.integers(0, size, 900) for size in grid.sizes]).astype(np.uint8)
    tree = trees.Tree.of_depth(2, max(grid.sizes))
    tree.factor[1:4] = 1, 0, 2
    tree.goes[1:4] = rng.random((3, max(grid.sizes))) < 0.5
    gradient, curvature = rng.normal(size=900), rng.random(900) * (rng.random(900) < 0.9)
    task = trees.TaskSums(numbers, grid, gradient, curvature)
    walked, present = tree.leaves(numbers), curvature > 0
    found = task(tree, [4, 7])
    for place, node in enumerate([4, 7]):
        own = present & (walked == node)
        assert (task.rows[node] == np.flatnonzero(own)).all()
        for factor, (a, b) in enumerate(zip(grid.starts, grid.starts[1:])):
            for i, weight in enumerate((gradient, curvature, np.ones(900))):
                expected = np.bincount(numbers[factor][own], weight[own], minlength=b - a)
                assert (found[i, place, a:b] == expected).all()


def test_three_models_share_one_grid_and_train_alone(prepared, monkeypatch):
    """Values of the factors are looked for once; six copies of scale 0.1 need no job for each level."""
    fitted, real = [], trees.Grid.fit
    monkeypatch.setattr(trees.Grid, "fit", lambda *args: fitted.append(args) or real(*args))
    few = [short(p, 1, depth=2) for p in (bt.FREQUENCY, bt.SEVERITY, bt.TRIGGER)]
    insights.train_models(prepared.cells, *few)
    assert len(fitted) == 1
    assert bt._tasks(prepared.cells.sparkSession, 829_035) == 1


def test_sums_by_pairs_of_factors_equal_those_by_single_ones(monkeypatch):
    monkeypatch.setattr(trees, "LEAST_PAIRED", 1_000)
    rng = np.random.default_rng(3)
    n = 4_000
    sizes = (3, 5, 4, 6, 9, 4)
    labels = [tuple("abcdefgh"[: s - 1]) if name in bt.CATEGORY_FACTORS else None for name, s in zip(bt.RATING_FACTORS, sizes)]
    cuts = [None if of else tuple(range(s - 1)) for of, s in zip(labels, sizes)]
    grid = trees.Grid(bt.RATING_FACTORS, tuple(labels), tuple(cuts))
    assert grid.sizes == sizes
    numbers = np.array([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    gradient, curvature = rng.integers(-9, 9, n).astype(float), rng.integers(1, 9, n).astype(float)
    pairs = trees.paired(numbers, grid)
    assert len(pairs) == 3
    plain = bt._grown(trees.TaskSums(numbers, grid, gradient, curvature), grid, bt.Boosting(rounds=1, depth=4))
    tree = bt._grown(trees.TaskSums(numbers, grid, gradient, curvature, pairs), grid, bt.Boosting(rounds=1, depth=4))
    assert (tree.factor == plain.factor).all() and (tree.goes == plain.goes).all() and (tree.sums == plain.sums).all()
    # Few rows are not worth a table of pairs.
    assert trees.paired(numbers[:, :100], grid) is None


def test_stored_trees_of_side_by_side_models_are_those_returned(prepared):
    saved = {}
    brief = bt.Boosting(rounds=3, depth=2, rounds_per_job=1)
    models = insights.train_models(prepared.cells, brief, brief, brief, save=lambda name, rows: saved.setdefault(name, []).extend(map(tuple, rows.collect())))
    assert {name: model.rows for name, model in models.items()} == saved

    def fails(name, rows):
        raise RuntimeError("disk full")

    with pytest.raises(RuntimeError, match="disk full"):
        insights.train_models(prepared.cells, brief, brief, brief, save=fails)


@pytest.mark.parametrize("most, n", [(1 << 15, 4_000), (500, 4_000), (1, 4_000), (1 << 15, 50)])
def test_sums_and_leaves_by_codes_equal_those_by_numbers(monkeypatch, most, n):
    """Few or many factors in a code, more and fewer rows than codes, and more leaves than a mask holds."""
    monkeypatch.setattr(trees, "MOST_CODES", most)
    monkeypatch.setattr(trees, "PIECE", 700)
    rng = np.random.default_rng(most)
    sizes = (5, 12, 20, 7)
    labels = (tuple("abcd"), None, None, None)
    grid = trees.Grid(tuple("wxyz"), labels, (None, *(tuple(np.arange(s - 1) + 0.5) for s in sizes[1:])))
    numbers = np.array([rng.integers(0, s, n) for s in sizes])
    target, volume, margin = rng.poisson(1, n).astype(float), rng.random(n) + 0.1, rng.normal(size=n) / 10
    codes, objective = grid.codes(numbers), bt.poisson()
    assert sorted(f for g in grid.groups for f in g) == [0, 1, 2, 3]
    whole, block = bt.Block(numbers, target, volume, margin), bt.Block(codes, target, volume, margin)
    plain = trees.TaskSums(numbers, grid, *whole.graded(objective))
    asked = []

    def both(tree, nodes):
        expected, found = plain(tree, nodes), bt._own_sums(block, grid, objective, tree, nodes)
        assert np.allclose(found, expected, atol=1e-9) and (found[2] == expected[2]).all()
        asked.extend(nodes)
        return expected

    tree = trees.grow(both, grid, 8, 1.0, 0.0, 0.0)
    steps = rng.normal(size=len(tree.factor))
    ends = tree.leaves(numbers)
    assert len(asked) > 1 and (n < 1_000 or len(set(ends)) > trees.MASK_BITS)
    assert (bt._moved(block, grid, tree, steps).margin == margin + steps[ends]).all()


def test_cells_are_dealt_out_once_per_training(prepared, monkeypatch):
    """Not again for every job of rounds, and every job's rows are handed on."""
    frame, packed, stored = type(prepared.cells), [], []
    plain = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, *args: packed.append(f) or plain(self, f, *args))
    model = insights.fit_frequency(
        prepared.cells, short(bt.FREQUENCY, 5, depth=2), tasks=3, save=lambda rows: stored.append(rows.count())
    )
    assert len(packed) == 1
    assert len(stored) == 4 and sum(stored) == len(model.rows) and model.rounds == 5
