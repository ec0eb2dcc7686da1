"""Centroid clustering of integer vectors, nearest centroids by a vantage-point tree.

Every round builds a tree over the centroids and broadcasts it; each task searches it
for its vectors, best node first, and adds up what moves the centroids. The bound of a
node is inclusive: a node is left out only if nothing in it can be as near as the best
centroid so far, so ties are all seen and go to the smaller number. Distances of
vantage points and leaves are whole numbers, without rounding.

Per round a task sends one row per centroid and component; the driver keeps the
centroids, whose size is fixed by the parameters. Nothing is cached: a lost executor
repeats the search of its own partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.vectors import finite_vectors, scaled
from millrace.session import stage

#: Centroids of a leaf at most, and bounds (vectors x nodes) that a task holds at once.
LEAF, HELD = 4, 1 << 22
#: Share by which a node's bound is lowered against rounding.
SLACK = 1e-9


@dataclass
class Node:
    """Centroids to compare with, and the parts of the tree below: ``(node, nearest, farthest)`` from ``tested[0]``."""

    tested: np.ndarray
    below: list[tuple[int, float, float]] = field(default_factory=list)


class VantageTree:
    """A vantage-point tree over the rows of ``points``, whole numbers."""

    def __init__(self, points: np.ndarray):
        self.points = np.asarray(points, np.float64)
        self.nodes: list[Node] = []
        if len(self.points):
            self._grow(np.arange(len(self.points)))

    def _grow(self, members: np.ndarray) -> int:
        own = len(self.nodes)
        if len(members) <= LEAF:
            self.nodes.append(Node(members))
            return own
        # The vantage point is the member farthest from the members' mean: its distances differ most.
        centre = self.points[members].mean(axis=0)
        vantage = members[((self.points[members] - centre) ** 2).sum(axis=1).argmax()]
        self.nodes.append(Node(np.array([vantage])))
        rest = members[members != vantage]
        far = np.sqrt(((self.points[rest] - self.points[vantage]) ** 2).sum(axis=1))
        order = far.argsort(kind="stable")
        for half in np.array_split(order, 2):
            if len(half):
                child = self._grow(rest[half])
                self.nodes[own].below.append((child, far[half].min(), far[half].max()))
        return own

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest point of each vector (ties: the smaller) and the squared distance."""
        numbers, distances = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.int64)
        step = max(1, HELD // max(1, len(self.nodes)))
        for start in range(0, len(vectors), step):
            numbers[start : start + step], distances[start : start + step] = self._search(vectors[start : start + step])
        return numbers, distances

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, number = np.full(len(vectors), np.inf), np.full(len(vectors), len(self.points))
        # Each vector's queue: the lower bound of the nodes it may open, endless for all others.
        queue = np.full((len(vectors), len(self.nodes)), np.inf)
        queue[:, 0] = 0
        searching = np.arange(len(vectors))
        while len(searching):
            chosen = queue[searching].argmin(axis=1)
            bound = queue[searching, chosen]
            open_ = np.isfinite(bound) & (bound * bound <= best[searching])
            searching, chosen, bound = searching[open_], chosen[open_], bound[open_]
            for at in np.unique(chosen).tolist():
                mine = chosen == at
                self._visit(at, searching[mine], bound[mine], vectors, queue, best, number)
        return number, best.astype(np.int64)

    def _visit(self, at: int, rows: np.ndarray, bound: np.ndarray, vectors: np.ndarray, queue: np.ndarray, best: np.ndarray, number: np.ndarray) -> None:
        node = self.nodes[at]
        queue[rows, at] = np.inf
        for centroid in node.tested.tolist():
            distance = ((vectors[rows] - self.points[centroid]) ** 2).sum(axis=1)
            nearer = (distance < best[rows]) | ((distance == best[rows]) & (centroid < number[rows]))
            best[rows[nearer]], number[rows[nearer]] = distance[nearer], centroid
        if node.below:
            away = np.sqrt(distance)  # the vantage point is the only one tested
            for child, low, high in node.below:
                least = np.maximum(away - high, low - away) - SLACK * (away + high)
                queue[rows, child] = np.maximum(least, bound)


def _integers(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """``vec_id`` and ``whole`` of the kept vectors that have an id and can be searched."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, places, rows in finite_vectors(batch.column(1)):
                if length == dimensions:
                    whole, exact = scaled(rows, scale)
                    lists = pa.array(list(whole[exact].astype(np.int64)), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places[exact])), lists], names=["vec_id", "whole"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.where("vec_id is not null").mapInArrow(run, f"vec_id {kind}, whole array<bigint>")


def _sums(vectors: DataFrame, tree: VantageTree, scale: int) -> DataFrame:
    """``cluster``, ``place``, ``total``, ``n``: sums of the components of each cluster's vectors."""
    clusters, dimensions = tree.points.shape
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((clusters, dimensions), np.int64), np.zeros(clusters, np.int64)
        for batch in batches:
            for length, _, rows in finite_vectors(batch.column(1)):
                if length == dimensions:
                    whole, exact = scaled(rows, scale)
                    numbers, _ = shared.value.nearest(whole[exact])
                    np.add.at(totals, numbers, whole[exact].astype(np.int64))
                    counts += np.bincount(numbers, minlength=clusters)
        used = np.flatnonzero(counts)
        columns = [np.repeat(used, dimensions), np.tile(np.arange(dimensions), len(used)), totals[used].ravel(), np.repeat(counts[used], dimensions)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "place", "total", "n"])

    partial = vectors.mapInArrow(run, "cluster long, place long, total long, n long")
    return partial.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))


def _assigned(vectors: DataFrame, tree: VantageTree, digests: list[str], scale: int, dimensions: int) -> DataFrame:
    kind = vectors.schema["vec_id"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, places, rows in finite_vectors(batch.column(1)):
                if length != dimensions:
                    continue
                whole, exact = scaled(rows, scale)
                numbers, distances = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                known = exact if digests else np.zeros_like(exact)
                numbers[known], distances[known] = shared.value.nearest(whole[known])
                names = [digests[n] if k else None for n, k in zip(numbers.tolist(), known.tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(places)), pa.array(numbers, pa.int32(), mask=~known), pa.array(distances, pa.int64(), mask=~known), pa.array(names, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance", "centroid_sha256"])

    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long, centroid_sha256 string")


def cluster(
    embeddings: DataFrame, dimensions: int = 64, scale: int = 64, clusters: int = 16, rounds: int = 3, seed: str = "1", id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256`` of each kept vector.

    Vectors with exactly ``dimensions`` components, none null or non-finite, are kept; a
    component x becomes ``floor(scale * x)``. Centroids start as the vectors with the
    smallest SHA-256 of ``seed:id`` (repeated ids: the smaller vector first), at most as
    many as there are. In each round every vector goes to its nearest centroid, ties to
    the smaller number, and a centroid with vectors moves to their floored mean; then
    vectors are assigned once more. ``cluster_inertia`` and ``inertia`` are sums of
    ``distance``, ``centroid_sha256`` is over the final centroid's components.

    Repeated rows count each and each gives its row. A vector without an id is assigned
    like any other, but starts no centroid. A vector whose whole components are so large
    that squared distances pass 2^53 (about 5.9 million at 64 dimensions), and every vector
    if none could start a centroid, keeps its row with null cluster, distance, cluster
    inertia and digest, and moves nothing; ``inertia`` is null if no vector has a distance.
    An empty table gives no rows; other columns are not read, whatever their names.
    """
    vectors = embeddings.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    whole = _integers(vectors, dimensions, scale).withColumn("hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    # At most `clusters` rows.
    centroids = [list(r.whole) for r in whole.orderBy("hash", "whole").limit(clusters).collect()]
    tree = VantageTree(np.array(centroids, np.float64).reshape(len(centroids), dimensions))
    for _ in range(rounds if centroids else 0):
        for r in _sums(vectors, tree, scale).collect():  # a row per centroid and component
            centroids[r.cluster][r.place] = int(r.total) // r.n
        tree = VantageTree(np.array(centroids, np.float64))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    assigned = stage(_assigned(vectors, tree, digests, scale, dimensions), "clusters")
    spread = assigned.where("cluster is not null").groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = {r.cluster: r.cluster_inertia for r in spread.collect()}  # a row per centroid
    inertia = sum(sums.values()) if sums else None
    pairs = [F.lit(x).cast(kind) for pair in sums.items() for x, kind in zip(pair, ("int", "long"), strict=True)]
    own = F.element_at(F.create_map(*pairs), F.col("cluster")) if sums else F.lit(None)
    return assigned.select("vec_id", "cluster", "distance", own.cast("long").alias("cluster_inertia"), F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256").withColumnRenamed("vec_id", id_column)
