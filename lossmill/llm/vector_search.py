"""Approximate nearest neighbours: a small-world graph for each shard of the vectors.

Equal vectors are one node, so that a crowd of copies does not fill a
neighbourhood; of a crowd only as many rows are kept as one answer can name. Nodes
are dealt out to shards by the hash of their vector. A shard's graph has layers of
falling size; each layer is one flat array of neighbours, a fixed number per node.
Graphs are written as rows, and each block of queries searches every shard's
graph. Answers carry the exact distance and are merged by it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

NEIGHBOURS = 16
BUILD_WIDTH = 80
SEARCH_WIDTH = 120
SHARD_ROWS = 6000
QUERY_BLOCK = 256


class Graph:
    """Hierarchical navigable small world over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.levels, self.links, self.entry = vectors, levels, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1) -> Graph:
        rows = len(vectors)
        draws = np.random.default_rng(seed).random(rows)
        levels = np.minimum((-np.log(1 - draws) / np.log(NEIGHBOURS)).astype(np.int64), 12)
        links = [np.full((rows, 2 * NEIGHBOURS if level == 0 else NEIGHBOURS), -1, dtype=np.int32) for level in range(int(levels.max(initial=0)) + 1)]
        graph = cls(vectors, levels, links, 0)
        for node in range(1, rows):
            graph._insert(node)
        return graph

    def _distances(self, point: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        gap = self.vectors[nodes] - point
        return np.einsum("ij,ij->i", gap, gap)

    def _descend(self, point: np.ndarray, start: int, distance: float, level: int) -> tuple[int, float]:
        """Walk to the nearest node of a layer."""
        while True:
            near = self.links[level][start]
            near = near[near >= 0]
            if not len(near):
                return start, distance
            found = self._distances(point, near)
            at = int(found.argmin())
            if found[at] >= distance:
                return start, distance
            start, distance = int(near[at]), float(found[at])

    def _near(self, point: np.ndarray, starts: list[tuple[float, int]], level: int, width: int) -> list[tuple[float, int]]:
        """The `width` nearest nodes that a best-first walk finds, nearest first."""
        seen = {node for _, node in starts}
        queue = list(starts)
        heapq.heapify(queue)
        best = [(-d, node) for d, node in starts]
        heapq.heapify(best)
        links = self.links[level]
        while queue:
            distance, node = heapq.heappop(queue)
            if distance > -best[0][0] and len(best) >= width:
                break
            fresh = [x for x in links[node].tolist() if x >= 0 and x not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for d, x in zip(self._distances(point, np.array(fresh)).tolist(), fresh):
                if len(best) < width:
                    heapq.heappush(best, (-d, x))
                    heapq.heappush(queue, (d, x))
                elif d < -best[0][0]:
                    heapq.heapreplace(best, (-d, x))
                    heapq.heappush(queue, (d, x))
        return sorted((-d, x) for d, x in best)

    def _choose(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions: each nearer to the node than to those chosen before; then the nearest."""
        chosen: list[int] = []
        rest: list[int] = []
        for distance, node in found:
            if len(chosen) == most:
                break
            if not chosen or self._distances(self.vectors[node], np.array(chosen)).min() > distance:
                chosen.append(node)
            else:
                rest.append(node)
        return chosen + rest[: most - len(chosen)]

    def _insert(self, node: int) -> None:
        point, top = self.vectors[node], int(self.levels[self.entry])
        start = self.entry
        distance = float(self._distances(point, np.array([start]))[0])
        for level in range(top, int(self.levels[node]), -1):
            start, distance = self._descend(point, start, distance, level)
        starts = [(distance, start)]
        for level in range(min(top, int(self.levels[node])), -1, -1):
            starts = self._near(point, starts, level, BUILD_WIDTH)
            chosen = self._choose(starts, NEIGHBOURS)
            links = self.links[level]
            links[node, : len(chosen)] = chosen
            for other in chosen:
                free = np.flatnonzero(links[other] < 0)
                if len(free):
                    links[other, free[0]] = node
                    continue
                near = np.append(links[other], node)
                found = sorted(zip(self._distances(self.vectors[other], near).tolist(), near.tolist()))
                links[other] = self._choose(found, links.shape[1])
        if self.levels[node] > top:
            self.entry = node

    def search(self, point: np.ndarray, width: int) -> list[int]:
        start = self.entry
        distance = float(self._distances(point, np.array([start]))[0])
        for level in range(int(self.levels[self.entry]), 0, -1):
            start, distance = self._descend(point, start, distance, level)
        return [x for _, x in self._near(point, [(distance, start)], 0, width)]


def _clean(vectors: DataFrame) -> DataFrame:
    """Rows vec_id, vector (doubles) of usable vectors; equal rows count once."""
    number = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("vector"))
    return rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(usable)


GRAPHS = (
    "shard long, width int, nodes int, entry int, vectors binary, levels binary, links array<binary>, "
    "member_node binary, member_id binary"
)


def _graph_row(rows: pd.DataFrame) -> pd.DataFrame:
    """The graph of one shard, its arrays flat, and the rows that stand behind each node."""
    rows = rows.sort_values(["content", "vec_id"], kind="stable")
    matrix = np.array(rows["vector"].tolist(), dtype=np.float64)
    fresh = np.ones(len(matrix), dtype=bool)
    fresh[1:] = (matrix[1:] != matrix[:-1]).any(axis=1)
    node = np.cumsum(fresh) - 1
    # Nodes in an order that has nothing to do with their hash or id.
    turn = np.random.default_rng(0).permutation(int(node[-1]) + 1)
    graph = Graph.build(matrix[fresh][np.argsort(turn)])
    return pd.DataFrame(
        {
            "shard": rows["shard"].iloc[:1].to_numpy(),
            "width": np.int32(matrix.shape[1]),
            "nodes": np.int32(len(graph.vectors)),
            "entry": np.int32(graph.entry),
            "vectors": [graph.vectors.tobytes()],
            "levels": [graph.levels.astype(np.int8).tobytes()],
            "links": [[x.tobytes() for x in graph.links]],
            "member_node": [turn[node].astype(np.int64).tobytes()],
            "member_id": [rows["vec_id"].to_numpy().astype(np.int64).tobytes()],
        }
    )


def _searched(batches: Iterator[pa.RecordBatch], nearest: int, width: int) -> Iterator[pa.RecordBatch]:
    """Each row holds a graph and a block of queries."""
    for batch in batches:
        for row in batch.to_pylist():
            vectors = np.frombuffer(row["vectors"]).reshape(row["nodes"], row["width"])
            links = [np.frombuffer(x, dtype=np.int32).reshape(row["nodes"], -1) for x in row["links"]]
            graph = Graph(vectors, np.frombuffer(row["levels"], dtype=np.int8), links, row["entry"])
            nodes, ids = (np.frombuffer(row[x], dtype=np.int64) for x in ("member_node", "member_id"))
            order = np.lexsort((ids, nodes))
            nodes, ids = nodes[order], ids[order]
            out: tuple[list, list, list] = ([], [], [])
            for query, point in zip(row["query_ids"], row["query_vectors"]):
                point = np.array(point)
                found = np.array(graph.search(point, max(width, nearest + 1)))
                low, high = np.searchsorted(nodes, found), np.searchsorted(nodes, found, side="right")
                members = np.concatenate([ids[a:b] for a, b in zip(low, high)])
                gaps = np.repeat(vectors[found] - point, high - low, axis=0)
                score = np.sqrt((gaps * gaps).sum(axis=1))
                members, score = members[members != query], score[members != query]
                best = np.lexsort((members, score))[:nearest]
                out[0].extend([query] * len(best))
                out[1].extend(members[best].tolist())
                out[2].extend(score[best].tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                ["query_id", "vec_id", "score"],
            )


def build_graphs(vectors: DataFrame, nearest: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: see GRAPHS. Shards grow in number with the table, not in size.

    Of equal vectors the `nearest` + 1 smallest ids are kept: no answer can name more.
    """
    rows = _clean(vectors)
    content = F.xxhash64(F.col("vector").cast("string"))
    equal = Window.partitionBy("width", "vector").orderBy("vec_id")
    rows = (
        rows.groupBy("vec_id", "vector")
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("width", F.size("vector"))
        .withColumn("copy", F.row_number().over(equal))
        .where(F.col("copy") <= nearest + 1)
        .select("vec_id", "vector", "width", content.alias("content"))
    )
    rows = cut_lineage(rows)
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "content"), F.lit(shards)) * 100_000 + F.col("width"))
    return cut_lineage(rows.groupBy("shard").applyInPandas(_graph_row, GRAPHS))


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    nearest: int = 10,
    width: int = SEARCH_WIDTH,
    shard_rows: int = SHARD_ROWS,
    graphs: DataFrame | None = None,
) -> DataFrame:
    """Rows query_id, rank, vec_id, score: the nearest other rows that the graphs yield.

    Score is the Euclidean distance of the original vectors in double precision; ties
    go to the smaller id. A vector takes no part if it or its id is NULL, if all of
    it is zero, or if a component is NULL or not finite; vectors are compared with
    those of their own length. Rows that repeat an id and its vector count once; an
    id with several vectors is several candidates, and as a query each is asked for
    and the best answers of all are kept. Empty tables give no rows.
    """
    graphs = build_graphs(vectors, nearest, shard_rows) if graphs is None else graphs
    asked = _clean(queries).withColumn("width", F.size("vector"))
    asked = asked.groupBy("vec_id", "vector", "width").agg(F.count(F.lit(1)).alias("times"))
    # Blocks of about QUERY_BLOCK queries, by the hash of their ids.
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = (
        asked.groupBy("width", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("vec_id", "vector")).alias("asked"))
        .select("width", "block", F.col("asked.vec_id").alias("query_ids"), F.col("asked.vector").alias("query_vectors"))
    )
    # The stated queries against all graphs, a block and a graph at a time.
    pairs = graphs.join(asked, "width").repartition(F.col("shard"), F.col("block"))
    found = pairs.mapInArrow(
        partial(_searched, nearest=nearest, width=width), "query_id long, vec_id long, score double"
    )
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
    )
