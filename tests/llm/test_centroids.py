"""Centroid clustering against plain integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np

from veil.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, code int, x double"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, 0.5) for r in rows], SCHEMA)


def brute(rows, k=8, rounds=10, n=64):
    kept = [(i, [math.floor(1024 * Fraction(x)) for x in v]) for i, v in rows if v is not None and len(v) == n and all(x is not None and math.isfinite(x) for x in v)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    own = [v for _, v in sorted(kept, key=lambda r: sha(f"3:{'' if r[0] is None else r[0]}"))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(own))[::-1]

    for _ in range(rounds):
        at = [nearest(v)[0] for _, v in kept]
        for c in range(len(own)):
            mine = [v for (_, v), a in zip(kept, at) if a == c]
            if mine:
                own[c] = [sum(x) // len(mine) for x in zip(*mine)]
    last, most = [nearest(v) for _, v in kept], 2**63 - 1
    per = {c: sum(min(d, most) for a, d in last if a == c) for c, _ in last}
    digest = [sha(",".join(map(str, c))) for c in own]
    found = [(i, c, min(d, most), min(per[c], most), min(sum(per.values()), most), digest[c]) for (i, _), (c, d) in zip(kept, last)]
    return sorted(found, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def vectors(seed, n, ids=None, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, spread) for _ in range(64)] for _ in range(5)]
    return [(ids[i] if ids else i, [m + rng.gauss(0, 0.3) for m in rng.choice(middles)]) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(1, 300)
    assert got(centroids.cluster_vectors(table(spark, rows).repartition(3))) == brute(rows)


def test_odd_vectors(spark):
    rows = vectors(2, 60, [i % 50 or 1000 + i for i in range(60)])
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63), (204, [math.nan] + [0.0] * 63), (205, [math.inf] * 64)]
    rows += [(300 + i, [0.25] * 64) for i in range(40)] + [(400, [-0.0] * 64)]
    assert got(centroids.cluster_vectors(table(spark, rows).repartition(3))) == brute(rows)


def test_ties_take_the_smaller_cluster(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.choice([0, 1]))] * 32 + [float(rng.choice([0, 1]))] * 32) for i in range(80)]
    assert got(centroids.cluster_vectors(table(spark, rows))) == brute(rows)


def test_components_of_any_size(spark):
    rows = vectors(3, 40)
    rows += [(500, [1e30] * 64), (501, [-1e30, 1e300] * 32), (502, [1.7e308] * 64), (503, [3e8 + 0.3] * 64)]
    assert got(centroids.cluster_vectors(table(spark, rows))) == brute(rows)


def test_few_and_no_vectors(spark):
    rows = vectors(4, 5)
    assert got(centroids.cluster_vectors(table(spark, rows))) == brute(rows)
    same = [(i, [0.5] * 64) for i in range(20)]
    assert got(centroids.cluster_vectors(table(spark, same))) == brute(same)
    assert centroids.cluster_vectors(table(spark, rows).limit(0)).count() == 0
    assert centroids.cluster_vectors(table(spark, [(1, None)])).count() == 0


def test_bounds_save_distances():
    rng = np.random.default_rng(1)
    middles = rng.integers(-4000, 4000, (8, 64))
    points = (middles[rng.integers(0, 8, 4000)] + rng.integers(-200, 200, (4000, 64))).astype(np.int64)
    pivots = centroids._spread(points, centroids.PIVOTS)
    away = np.sqrt([centroids.squared(points, p) for p in pivots]).T
    from_pivots = np.sqrt([centroids.squared(pivots, c) for c in middles])
    cluster, distance, computed = centroids.assign(points, away, middles, from_pivots)
    every = np.array([centroids.squared(points, c) for c in middles])
    assert (cluster == every.argmin(axis=0)).all() and (distance == every.min(axis=0)).all()
    assert computed < 2 * len(points)
