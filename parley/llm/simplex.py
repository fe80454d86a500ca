"""Centroid clustering with n-simplex projection.

A few pivots span a simplex.  The distances of a vector to them, computed
once and stored, give it an *apex*: coordinates in the space of the simplex
and a height above it.  For two apexes the Euclidean distance is a lower
bound of the vectors' distance, and with the heights on opposite sides of
the simplex an upper bound.  In each assignment a centroid whose lower bound
exceeds the least upper bound is left out; the others are compared exactly,
in integers.

Vectors are integers, floor(scale * x).  Every round is one narrow pass over
the stored vectors and apexes; tasks give sums for each cluster, which are
added up exactly on Spark.  The driver holds the centroids only.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.words import stage

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 12
_NARROW = 1 << 27         # components below it: squared distances fit 64 bits
_LIMB = 40                # bits of a part of a sum
_SLACK = 1e-6             # of the squared distances; far above the rounding of the bounds
_LONG_MAX = (1 << 63) - 1


def quantised(values, dimensions: int = DIMENSIONS, scale: int = SCALE) -> list[int] | None:
    """floor(scale * x) of every component; None for a vector that takes no part."""
    if values is None or len(values) != dimensions or any(
            v is None or not math.isfinite(v) for v in values):
        return None
    return [int(v) * scale if abs(v) >= 2.0 ** 53 else math.floor(scale * v) for v in values]


class Simplex:
    """Pivots, chosen far from each other among given integer vectors, and apexes over them."""

    def __init__(self, choices: list[list[int]], most: int = PIVOTS):
        points = np.array([c for c in choices if max(map(abs, c)) <= _NARROW], np.int64
                          ).reshape(-1, len(choices[0]) if choices else 1)
        self.pivots = points[:1]
        self.base = np.zeros((len(self.pivots), 0))
        while len(points) and len(self.pivots) < most:
            coordinates, heights = self.apexes(points)
            far = int(heights.argmax())
            reach = np.sqrt((coordinates ** 2).sum(axis=1) + heights ** 2).max()
            if heights[far] <= 1e-3 * reach:
                break                             # the others lie almost in the simplex
            self.base = np.pad(self.base, ((0, 1), (0, 1)))
            self.base[-1] = [*coordinates[far], heights[far]]
            self.pivots = np.vstack([self.pivots, points[far]])

    def apexes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the space of the pivots, and the height above it."""
        rows, n = len(vectors), len(self.pivots)
        if not n:
            return np.zeros((rows, 0)), np.zeros(rows)
        squared = np.stack([((vectors - p) ** 2).sum(axis=1) for p in self.pivots], axis=1
                           ).astype(np.float64)
        found = np.zeros((rows, n - 1))
        for j in range(1, n):                     # the base is lower triangular
            corner = self.base[j]
            known = found[:, :j - 1] @ corner[:j - 1]
            found[:, j - 1] = ((squared[:, 0] - squared[:, j] + corner @ corner) / 2 - known
                               ) / corner[j - 1]
        return found, np.sqrt(np.maximum(squared[:, 0] - (found ** 2).sum(axis=1), 0))

    def candidates(self, apexes, centres) -> np.ndarray:
        """Mask rows x centroids: those that the bounds cannot leave out."""
        (x, hx), (c, hc) = apexes, centres
        flat = (x ** 2).sum(axis=1)[:, None] + (c ** 2).sum(axis=1) - 2 * x @ c.T
        slack = _SLACK * (((x ** 2).sum(axis=1) + hx ** 2)[:, None]
                          + (c ** 2).sum(axis=1) + hc ** 2 + 1)
        low = flat + (hx[:, None] - hc) ** 2 - slack
        high = flat + (hx[:, None] + hc) ** 2 + slack
        return low <= high.min(axis=1, keepdims=True)


def nearest_centroids(vectors: np.ndarray, apexes, centroids: list[list[int]],
                      simplex: Simplex) -> tuple[np.ndarray, list[int], np.ndarray]:
    """Cluster (ties: the smaller), exact squared distance, and centroids compared, by row."""
    if vectors.dtype == object or any(max(map(abs, c)) > _NARROW for c in centroids):
        wide = vectors.astype(object)
        squared = np.stack([((wide - np.array(c, object)) ** 2).sum(axis=1) for c in centroids], 1)
        cluster = np.array([min(range(len(row)), key=row.__getitem__) for row in squared], np.int64)
        return (cluster, [int(row[k]) for row, k in zip(squared, cluster, strict=True)],
                np.full(len(vectors), len(centroids)))
    points = np.array(centroids, np.int64)
    mask = simplex.candidates(apexes, simplex.apexes(points))
    best = np.full(len(vectors), _LONG_MAX, np.int64)
    cluster = np.zeros(len(vectors), np.int64)
    for k, point in enumerate(points):
        rows = np.flatnonzero(mask[:, k])
        squared = ((vectors[rows] - point) ** 2).sum(axis=1)
        nearer = squared < best[rows]
        best[rows[nearer]], cluster[rows[nearer]] = squared[nearer], k
    return cluster, best.tolist(), mask.sum(axis=1)


_STORED = "vec_id bigint, vector binary, wide string, apex binary"


def _quantise(simplex: Simplex | None, dimensions: int, scale: int, key: str, column: str):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids, narrow, wide = [], [], []
            for k, values in zip(batch.column(key).to_pylist(), batch.column(column).to_pylist(),
                                 strict=True):
                q = quantised(values, dimensions, scale)
                if q is not None:
                    fits = max(map(abs, q)) <= _NARROW
                    ids.append(k)
                    narrow.append(q if fits else [0] * dimensions)
                    wide.append(None if fits else ",".join(map(str, q)))
            vectors = np.array(narrow, np.int64).reshape(-1, dimensions)
            apex = [b""] * len(ids)
            if simplex is not None:
                apex = [row.tobytes() for row in np.column_stack(simplex.apexes(vectors))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()),
                 pa.array([row.tobytes() for row in vectors.astype("<i4")], pa.binary()),
                 pa.array(wide, pa.string()), pa.array(apex, pa.binary())],
                ["vec_id", "vector", "wide", "apex"])
    return run


def _assigned(batch: pa.RecordBatch, centroids: list[list[int]], simplex: Simplex):
    """(vectors, cluster, distance, compared) of a batch of stored rows."""
    n, dimensions = batch.num_rows, len(centroids[0])
    vectors = np.frombuffer(b"".join(batch.column("vector").to_pylist()), "<i4"
                            ).reshape(n, dimensions).astype(np.int64)
    apex = np.frombuffer(b"".join(batch.column("apex").to_pylist()), np.float64).reshape(n, -1)
    for i, text in enumerate(batch.column("wide").to_pylist()):
        if text is not None:
            vectors = vectors.astype(object) if vectors.dtype != object else vectors
            vectors[i] = [int(v) for v in text.split(",")]
    return vectors, *nearest_centroids(vectors, (apex[:, :-1], apex[:, -1]), centroids, simplex)


def _sums(stored: DataFrame, centroids: list[list[int]], simplex: Simplex) -> list[list[int]]:
    """The centroids' successors: exact floor(sum / count) of every non-empty cluster.

    A task's sums are split into limbs, so that adding them up is exact for
    components of any size.  At most clusters x components x limbs rows come
    to the driver.
    """
    dimensions = len(centroids[0])

    def run(batches):
        counts = [0] * len(centroids)
        sums = [[0] * dimensions for _ in centroids]
        for batch in batches:
            vectors, cluster, _, _ = _assigned(batch, centroids, simplex)
            for k in np.unique(cluster).tolist():
                mine = vectors[cluster == k]
                counts[k] += len(mine)
                sums[k] = [a + int(b) for a, b in zip(sums[k], mine.sum(axis=0), strict=True)]
        rows = []
        for k, count in enumerate(counts):
            if count:
                rows.append((k, -1, 0, count))
            for at, total in enumerate(sums[k]):
                sign, total, limb = (-1 if total < 0 else 1), abs(total), 0
                while total:
                    rows.append((k, at, limb, sign * (total & ((1 << _LIMB) - 1))))
                    total, limb = total >> _LIMB, limb + 1
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["cluster", "place", "limb", "part"])
    added = (stored.mapInArrow(run, "cluster int, place int, limb int, part bigint")
             .groupBy("cluster", "place", "limb")
             .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    counts: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for row in added:
        if row["place"] < 0:
            counts[row["cluster"]] = int(row["total"])
        else:
            mine = sums.setdefault(row["cluster"], [0] * dimensions)
            mine[row["place"]] += int(row["total"]) << (_LIMB * row["limb"])
    return [[s // counts[k] for s in sums.get(k, [0] * dimensions)] if k in counts else old
            for k, old in enumerate(centroids)]


def cluster_vectors(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS,
                    dimensions: int = DIMENSIONS, scale: int = SCALE, pivots: int = PIVOTS,
                    key: str = "vec_id", column: str = "embedding"
                    ) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance, compared) of every vector, and the final centroids.

    Vectors that are null, of another size, or hold a null or non-finite
    component take no part.  The first centroids are the vectors of smallest
    lower-case hex sha256 of ``1:<vec_id>`` (a null id: nothing after the
    colon; equal ids by their components); with fewer vectors than clusters
    every vector is one.  ``distance`` is the exact squared distance, null
    where it exceeds a long; ``compared`` counts the centroids that the
    bounds left for an exact comparison.  Repeated rows count each; an empty
    table gives no rows and no centroids.  Other columns are not read.
    """
    source = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("vector_in"))
    plain = source.mapInArrow(_quantise(None, dimensions, scale, "vec_id", "vector_in"), _STORED)
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = plain.orderBy(order, "wide", "vector").limit(clusters).collect()
    centroids = [np.frombuffer(r["vector"], "<i4").tolist() if r["wide"] is None
                 else [int(v) for v in r["wide"].split(",")] for r in first]
    schema = "vec_id bigint, cluster int, distance bigint, compared int"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], schema), []
    simplex = Simplex(centroids, pivots)
    stored = stage(source.mapInArrow(
        _quantise(simplex, dimensions, scale, "vec_id", "vector_in"), _STORED))
    for _ in range(rounds):
        centroids = _sums(stored, centroids, simplex)

    def assign(batches):
        for batch in batches:
            _, cluster, squared, compared = _assigned(batch, centroids, simplex)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()),
                 pa.array([d if d <= _LONG_MAX else None for d in squared], pa.int64()),
                 pa.array(compared, pa.int32())], ["vec_id", "cluster", "distance", "compared"])
    return stored.mapInArrow(assign, schema), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The assigned rows with cluster_inertia, inertia and centroid_sha256.

    The sums are exact; one that exceeds a long, or has a null distance in
    it, is null.  The joined table has one row a cluster.
    """
    assigned = stage(assigned)
    exact = F.when(F.count(F.when(F.col("distance").isNull(), 1)) == 0,
                   F.sum(F.col("distance").cast("decimal(38,0)")))
    by_cluster = {r["cluster"]: r["total"] for r in
                  assigned.groupBy("cluster").agg(exact.alias("total")).collect()}

    def fitting(total):
        return None if total is None or total > _LONG_MAX else int(total)
    whole = None if None in by_cluster.values() else fitting(sum(by_cluster.values()))
    rows = [(k, fitting(total), whole,
             hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
            for k, total in sorted(by_cluster.items())]
    table = assigned.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster")
