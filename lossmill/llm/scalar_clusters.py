"""Centroid clustering of whole-number vectors by lookup tables of squared differences.

Components are scaled to integers once and written as blocks: per dimension the
different values that occur in the block, and for every vector the number of its
value. A round tabulates, for each dimension, occurring value and centroid, the
squared difference; a distance is then a sum of table entries, so no vector is
multiplied with a centroid. All sums are exact integers: results do not depend on
how rows are stored, and a lost executor repeats only its own blocks of a round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

DIMENSIONS = 64
CLUSTERS = 16
ROUNDS = 3
#: Components are multiplied by this and rounded down.
SCALE = 64
#: Vectors per block; their value numbers fit 16 bits.
BLOCK = 4096
#: Scaled components stay below, so that a squared distance fits 64 bits.
MOST = float(1 << 27)

BLOCKS = "ids array<bigint>, sizes binary, numbers binary, codes binary"
_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("numbers", pa.binary()), ("codes", pa.binary())])


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: int) -> DataFrame:
    """Rows id, values: floor(scale * x) of each component, for the vectors that take part."""
    raw = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("raw"))
    fits = F.forall("raw", lambda x: x.isNotNull() & (F.abs(x * scale) < MOST))
    values = F.transform("raw", lambda x: F.floor(x * scale).cast("long"))
    return raw.where((F.size("raw") == dimensions) & F.coalesce(fits, F.lit(False))).select("id", values.alias("values"))


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            part = batch.slice(first, BLOCK)
            matrix = part["values"].flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dimensions)
            codes = np.empty(matrix.shape, dtype=np.uint16)
            numbers = []
            for d in range(dimensions):
                found, codes[:, d] = np.unique(matrix[:, d], return_inverse=True)
                numbers.append(found)
            sizes = np.array([len(x) for x in numbers], dtype=np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "ids": [part["id"].to_pylist()],
                    "sizes": [sizes.tobytes()],
                    "numbers": [np.concatenate(numbers).astype(np.int64).tobytes()],
                    "codes": [codes.tobytes()],
                },
                schema=_ARROW,
            )


def distances(numbers: np.ndarray, sizes: np.ndarray, codes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every coded vector to every centroid, from one table per dimension."""
    dimension = np.repeat(np.arange(len(sizes)), sizes)
    table = (numbers[:, None] - centroids.T[dimension]) ** 2
    starts = np.cumsum(sizes) - sizes
    total = np.zeros((len(codes), len(centroids)), dtype=np.int64)
    for d, start in enumerate(starts):
        total += table[start + codes[:, d]]
    return total


def _opened(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple]:
    for batch in batches:
        for ids, sizes, numbers, codes in zip(*(batch[c] for c in ("ids", "sizes", "numbers", "codes"))):
            yield (
                ids.values,
                np.frombuffer(sizes.as_buffer(), dtype=np.int32),
                np.frombuffer(numbers.as_buffer(), dtype=np.int64),
                np.frombuffer(codes.as_buffer(), dtype=np.uint16).reshape(-1, dimensions).astype(np.int64),
            )


def _sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per cluster and dimension of a task: sum of the components and number of vectors."""
    clusters, dimensions = centroids.shape
    total, count = np.zeros((clusters, dimensions), dtype=np.int64), np.zeros(clusters, dtype=np.int64)
    for _, sizes, numbers, codes in _opened(batches, dimensions):
        nearest = distances(numbers, sizes, codes, centroids).argmin(axis=1)
        values = numbers[np.cumsum(sizes) - sizes + codes]
        np.add.at(total, nearest, values)
        count += np.bincount(nearest, minlength=clusters)
    cluster, dimension = (x.reshape(-1) for x in np.indices(total.shape))
    columns = [cluster.astype(np.int32), dimension.astype(np.int32), total.reshape(-1), count[cluster]]
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["cluster", "dimension", "total", "vectors"])


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for ids, sizes, numbers, codes in _opened(batches, centroids.shape[1]):
        found = distances(numbers, sizes, codes, centroids)
        nearest = found.argmin(axis=1)
        columns = [pa.array(nearest.astype(np.int32)), pa.array(found[np.arange(len(nearest)), nearest])]
        yield pa.RecordBatch.from_arrays([ids, *columns], ["id", "cluster", "distance"])


def centroid_clusters(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dimensions: int = DIMENSIONS,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """Rows vec_id, cluster, distance, cluster_inertia, inertia, centroid (array<long>), one for each vector.

    Starts from the vectors whose ids have the smallest SHA-256 of ``1:<id>``; every
    round assigns all vectors to the nearest centroid and replaces each centroid that
    has vectors by the rounded-down mean of its components; then all are assigned once
    more. Ties go to the smaller number. A cluster without vectors keeps its centroid.

    Vectors that are NULL, of another length or hold a NULL or non-finite component
    take no part, nor do those with a scaled component of 2**27 or more, whose
    distances could exceed 64 bits. Rows that repeat an id are vectors of their own
    (equal hashes are ordered by components); rows without an id come last in the
    starting order. With fewer vectors than clusters there are as many clusters as
    vectors; an empty table gives no rows. An inertia beyond 64 bits is NULL. Other
    columns are ignored.
    """
    whole = whole_vectors(vectors, id_column, vector_column, dimensions, scale)
    blocks = cut_lineage(whole.mapInArrow(partial(_blocks, dimensions=dimensions), BLOCKS))
    first = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    start = whole.orderBy(first.asc_nulls_last(), "values").limit(clusters).collect()
    centroids = np.array([r["values"] for r in start], dtype=np.int64).reshape(-1, dimensions)
    schema = "id long, cluster int, distance long"
    if not len(centroids):
        rows = blocks.sparkSession.createDataFrame([], schema)
        missing = [F.lit(None).cast("long").alias(c) for c in ("cluster_inertia", "inertia")]
        return rows.select(F.col("id").alias("vec_id"), "cluster", "distance", *missing, F.lit(None).cast("array<long>").alias("centroid"))
    for _ in range(rounds):
        parts = blocks.mapInArrow(partial(_sums, centroids=centroids), "cluster int, dimension int, total long, vectors long")
        sums = parts.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("vectors").alias("vectors"))
        centroids = centroids.copy()
        # One row for each cluster and dimension, whatever the number of vectors.
        for cluster, dimension, total, count in sums.where("vectors > 0").collect():
            centroids[cluster, dimension] = total // count
    found = cut_lineage(blocks.mapInArrow(partial(_assigned, centroids=centroids), schema))
    of_cluster = dict(found.groupBy("cluster").agg(F.try_sum("distance")).collect())
    every = None if None in of_cluster.values() else sum(of_cluster.values())
    every = every if every is not None and every < 1 << 63 else None
    lists = [F.lit(of_cluster.get(c)).cast("long") for c in range(len(centroids))]
    middles = [F.array(*[F.lit(int(x)).cast("long") for x in row]) for row in centroids]
    return found.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        F.get(F.array(*lists), F.col("cluster")).alias("cluster_inertia"),
        F.lit(every).cast("long").alias("inertia"),
        F.get(F.array(*middles), F.col("cluster")).alias("centroid"),
    )
