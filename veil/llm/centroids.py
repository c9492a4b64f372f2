"""Centroid clustering in exact integers, with a table of pivot distances in front of the distance computation.

Every vector's distances to a few fixed pivots are computed once and stored beside it. In a round the
distances of the centroids to the same pivots are known, and by the triangle inequality the largest
difference of the two bounds the distance of vector and centroid from below. The centroid with the
smallest bound is measured first; another one is measured only while its bound does not exceed the best
distance so far. Bounds are floating point with a margin above their rounding error, and a bound equal
to the best distance never excludes, so ties are decided by exact integers.

A round is one scan: tasks assign their vectors and send the sums per cluster and component, which
Spark adds up. Only centroids, pivots and those sums pass through the driver, and their number does
not depend on the number of vectors.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.llm.common import column, stored

CLUSTERS, ROUNDS, DIMENSIONS = 8, 10, 64
SCALE = 1024
PIVOTS = 12
# Pivots are chosen from this many vectors, each the farthest from those before it.
PIVOT_SAMPLE = 128
# Components up to this size keep squared distances of 2 ** 11 components inside 64 bits.
_SMALL = 1 << 25
# A larger integer is added up in limbs of so many bits.
_LIMB = 40
_MOST = 2**63 - 1
_MARGIN = 1e-9
_PART = 1 << 14  # vectors at a time
_TABLE = "vec_id long, code binary, large string, pivots binary"


def whole_components(embedding: Column, dimensions: int = DIMENSIONS) -> Column:
    """Whether a vector takes part: the right number of components, none null or without a finite value."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return embedding.isNotNull() & (F.size(embedding) == dimensions) & F.coalesce(finite, F.lit(False))


def scaled(values: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, dict[int, list[int]]]:
    """``floor(scale * x)`` of a matrix as int64, and the rows whose integers are too large for the fast way."""
    with np.errstate(over="ignore"):
        product = np.floor(values * scale)
    large = ~(np.abs(product) <= _SMALL).all(axis=1)
    exact = {}
    for i in np.flatnonzero(large):
        # a double this large is an integer, and so is its multiple
        exact[int(i)] = [int(x) * scale if abs(x) >= 2**52 else int(np.floor(x * scale)) for x in values[i].tolist()]
    return np.where(large[:, None], 0, product).astype(np.int64), exact


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of an integer matrix to one centroid."""
    difference = vectors - centroid
    return np.einsum("ij,ij->i", difference, difference)


def assign(vectors: np.ndarray, pivots: np.ndarray, centroids: np.ndarray, from_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each vector, its squared distance, and how many distances were computed.

    ``pivots`` has the distances of the vectors to the pivots, ``from_pivots`` those of the centroids.
    """
    n, k = len(vectors), len(centroids)
    bound = np.zeros((n, k))
    for c in range(k):
        for p in range(pivots.shape[1]):
            gap = np.abs(pivots[:, p] - from_pivots[c, p]) - _MARGIN * (pivots[:, p] + from_pivots[c, p])
            np.maximum(bound[:, c], gap, out=bound[:, c])
    # squared and rounded down, as the distances are integers
    bound = np.floor(bound * bound * (1 - _MARGIN))
    first = bound.argmin(axis=1)
    best = np.zeros(n, np.int64)
    for c in range(k):
        here = np.flatnonzero(first == c)
        best[here] = squared(vectors[here], centroids[c])
    cluster, computed = first.copy(), n
    for c in range(k):
        here = np.flatnonzero((bound[:, c] <= best) & (first != c))
        distance = squared(vectors[here], centroids[c])
        computed += len(here)
        better = (distance < best[here]) | ((distance == best[here]) & (c < cluster[here]))
        best[here[better]], cluster[here[better]] = distance[better], c
    return cluster, best, computed


def assign_large(rows: Sequence[Sequence[int]], centroids: Sequence[Sequence[int]]) -> list[tuple[int, int]]:
    """The same for integers of any size, by plain comparison."""
    return [min((sum((x - y) ** 2 for x, y in zip(r, c)), k) for k, c in enumerate(centroids))[::-1] for r in rows]


class _Model:
    """Centroids of any integers, and the pivots' distances to them where those fit."""

    def __init__(self, centroids: list[list[int]], pivots: np.ndarray):
        self.centroids = centroids
        self.small = all(abs(x) <= _SMALL for c in centroids for x in c)
        if self.small:
            self.array = np.array(centroids, np.int64)
            self.from_pivots = np.array([np.sqrt(squared(pivots, c)) for c in self.array]).reshape(len(centroids), len(pivots))

    def of(self, batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[list[int]], list[int], list[int]]]:
        """Parts of a batch: places, the integers of those places, and cluster and distance of each."""
        large = [(i, json.loads(x)) for i, x in enumerate(batch.column("large").to_pylist()) if x is not None]
        others = np.setdiff1d(np.arange(batch.num_rows), [i for i, _ in large])
        own = batch.take(pa.array(others))
        codes = np.frombuffer(b"".join(own.column("code").to_pylist()), "<i4").reshape(-1, dimensions)
        away = np.frombuffer(b"".join(own.column("pivots").to_pylist()), "<f8").reshape(len(codes), -1)
        for at in range(0, len(codes) if self.small else 0, _PART):
            part = slice(at, at + _PART)
            vectors = codes[part].astype(np.int64)
            cluster, distance, _ = assign(vectors, away[part], self.array, self.from_pivots)
            yield others[part], vectors, [], cluster, distance
        if not self.small:
            large += [(int(i), c) for i, c in zip(others, codes.tolist())]
        if large:
            found = assign_large([x for _, x in large], self.centroids)
            clusters, distances = (np.array(x) for x in zip(*[(c, min(d, _MOST)) for c, d in found]))
            yield np.array([i for i, _ in large]), None, [x for _, x in large], clusters, distances.astype(np.int64)


def pivot_table(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dimensions: int = DIMENSIONS) -> tuple[DataFrame, np.ndarray]:
    """The vectors that take part as integers, with their distances to the pivots, stored; and the pivots."""
    kept = vectors.select(column(vec_id).cast("long").alias("vec_id"), column(embedding).cast("array<double>").alias("e")).where(
        whole_components(F.col("e"), dimensions)
    )
    sample = kept.orderBy(F.xxhash64("e", "vec_id"), "vec_id", "e").limit(PIVOT_SAMPLE).select("e").collect()
    integers, large = scaled(np.array([r.e for r in sample], float).reshape(-1, dimensions))
    pivots = _spread(integers[[i for i in range(len(sample)) if i not in large]], PIVOTS)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _PART):
                part = batch.slice(at, _PART)
                values = part.column("e").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
                integers, exact = scaled(values)
                away = np.array([np.sqrt(squared(integers, p)) for p in pivots]).reshape(len(pivots), len(integers)).T
                columns = [
                    part.column("vec_id"),
                    pa.array([None if i in exact else x.tobytes() for i, x in enumerate(integers.astype("<i4"))], pa.binary()),
                    pa.array([json.dumps(exact[i]) if i in exact else None for i in range(len(integers))], pa.string()),
                    pa.array([x.tobytes() for x in np.ascontiguousarray(away, "<f8")], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "code", "large", "pivots"])

    return stored(kept.mapInArrow(code, _TABLE), "pivot-table"), pivots


def _spread(vectors: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other, chosen one by one; no vector twice."""
    chosen: list[int] = []
    away = np.full(len(vectors), np.iinfo(np.int64).max)
    while len(chosen) < min(count, len(vectors)) and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, squared(vectors, vectors[chosen[-1]]))
    return vectors[chosen]


def first_centroids(table: DataFrame, clusters: int, salt: str, dimensions: int) -> list[list[int]]:
    """The vectors whose ``salt:vec_id`` has the smallest hashes; of one id, the smaller vector first."""
    key = F.sha2(F.concat(F.lit(salt + ":"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = table.orderBy(key, "large", "code").limit(clusters).select("large", "code").collect()
    return [json.loads(r.large) if r.large else np.frombuffer(r.code, "<i4").tolist() for r in rows]


def next_centroids(table: DataFrame, model: _Model, dimensions: int) -> list[list[int]]:
    """Centroids moved to the floor of the exact mean of their vectors; empty ones stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.centroids)
        sums, counts, limbs = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64), {}
        for batch in batches:
            for _, vectors, exact, cluster, _ in model.of(batch, dimensions):
                counts += np.bincount(cluster, minlength=k)
                for c in range(k if vectors is not None else 0):
                    sums[c] += vectors[cluster == c].sum(axis=0)
                for row, c in zip(exact, cluster.tolist()):
                    for d, x in enumerate(row):
                        sign, x, limb = (1, x, 0) if x >= 0 else (-1, -x, 0)
                        while x:
                            place = (c, d, limb)
                            limbs[place] = limbs.get(place, 0) + sign * (x & ((1 << _LIMB) - 1))
                            x, limb = x >> _LIMB, limb + 1
        rows = [(c, -1, 0, int(n)) for c, n in enumerate(counts)]
        rows += [(c, d, 0, int(sums[c, d])) for c in range(k) for d in range(dimensions) if counts[c]]
        rows += [(*place, x) for place, x in limbs.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["cluster", "d", "limb", "x"])

    parts = table.mapInArrow(run, "cluster long, d long, limb long, x long")
    total = F.sum(F.col("x").cast("decimal(38,0)")).alias("x")
    found = {(r.cluster, r.d, r.limb): int(r.x) for r in parts.groupBy("cluster", "d", "limb").agg(total).collect()}
    moved = []
    for c, old in enumerate(model.centroids):
        n = found.get((c, -1, 0), 0)
        sums = [0] * dimensions
        for (k, d, limb), x in found.items():
            if k == c and d >= 0:
                sums[d] += x << (_LIMB * limb)
        moved.append([s // n for s in sums] if n else old)
    return moved


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    salt: str = "3",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """One row per vector that takes part: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors that are null, hold a null or a component that is not finite, or have another number of
    components take no part. Rows that repeat an id or a vector are vectors of their own; a null id hashes
    like an empty one. Fewer vectors than clusters give as many clusters as vectors, an empty table gives
    no rows. Integers may have any size; distances and inertias beyond 64 bits are given as the largest
    long. Other columns are ignored.
    """
    table, pivots = pivot_table(vectors, vec_id, embedding, dimensions)
    centroids = first_centroids(table, clusters, salt, dimensions)
    for _ in range(rounds if centroids else 0):
        moved = next_centroids(table, _Model(centroids, pivots), dimensions)
        if moved == centroids:
            break  # every later round repeats this one
        centroids = moved
    model = _Model(centroids, pivots) if centroids else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for places, _, _, cluster, distance in model.of(batch, dimensions) if batch.num_rows else ():
                columns = [ids.take(pa.array(places)), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = stored(table.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    per_cluster = F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")
    # one row per cluster
    sums = {r.cluster: int(r.x) for r in assigned.groupBy("cluster").agg(per_cluster).collect()}
    inertia = min(sum(sums.values()), _MOST)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    known = [(c, min(x, _MOST), digests[c]) for c, x in sums.items()]
    known = vectors.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256"
    )
