import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossmill.llm.scalar_clusters import centroid_clusters, distances


def plain(rows, dimensions, clusters, rounds):
    """Clusters of (id, vector) rows by plain integer arithmetic."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in hashed[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for k in set(of):
            mine = [v for (_, v), c in zip(kept, of) if c == k]
            centres[k] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = {k: sum(d for _, d, c in last if c == k) for k in range(len(centres))}
    return sorted((i is None, i or 0, c, d, inertia[c], sum(inertia.values()), centres[c]) for i, d, c in last)


def found(spark, rows, parts=3, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x")).withColumn("values", F.lit(1))
    got = centroid_clusters(frame.repartition(parts), **options).collect()
    return sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in got)


@pytest.mark.parametrize("parts", [1, 4])
def test_clusters_equal_plain_arithmetic(spark, parts):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 5) + (i % 4)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(90)] + [(7, rows[8][1]), (7, rows[7][1])]
    options = {"dimensions": 5, "clusters": 6, "rounds": 3}
    assert found(spark, rows, parts, **options) == plain(rows, **options)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0]), (None, [-0.01, 0.0]), (8, []), (9, [1e30, 0.0])]
    options = {"dimensions": 2, "clusters": 4, "rounds": 2}
    assert found(spark, rows, **options) == plain(rows[:1] + [rows[6]], **options)
    assert found(spark, rows[1:4], **options) == []


def test_tables_give_exact_distances():
    rng = np.random.default_rng(1)
    matrix, centres = rng.integers(-9, 9, (50, 3)), rng.integers(-9, 9, (4, 3))
    parts = [np.unique(matrix[:, d], return_inverse=True) for d in range(3)]
    got = distances(np.concatenate([p[0] for p in parts]), np.array([len(p[0]) for p in parts]), np.array([p[1] for p in parts]).T, centres)
    assert (got == ((matrix[:, None] - centres[None]) ** 2).sum(axis=2)).all()
