"""Exact top-k search against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veil.llm import topk


def _expected(rows, k=10):
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    out = []
    for q, a in sorted(set((i, tuple(v)) for i, v in ints)):
        if q % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def _search(spark, rows, k=10):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = vectors.withColumns({"q": F.lit("x"), "vector": F.lit(1), "asks": F.lit(2)})
    return sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k).collect())


@pytest.mark.parametrize("part", [3, 1024])
def test_top_k(spark, monkeypatch, part):
    monkeypatch.setattr(topk, "PART", part)
    rng = np.random.default_rng(part)
    rows = [(int(i), rng.normal(0, 0.2, 8).tolist()) for i in rng.permutation(700)]
    rows += [(1000, [0.0] * 8), (1001, [0.1] * 8), (1002, [0.1] * 8), (1001, [0.1] * 8), (1003, [-0.1] * 8)]
    assert _search(spark, rows) == _expected(rows)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [float("nan"), 1.0]), (2, [float("inf"), 1.0]), (3, None), (4, [None, 1.0]), (5, [0.5, 0.5]), (100, None), (6, [1.0])]
    good = [(0, [1.0, 2.0]), (5, [0.5, 0.5]), (6, [1.0, 0.0])]
    assert _search(spark, rows) == _expected(good)


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(2**28 + i), float(-(2**27) + 3 * i), 0.25]) for i in range(0, 40)]
    top = 2**63 - 1
    assert _search(spark, rows, 5) == [(q, r, i, min(top, s)) for q, r, i, s in _expected(rows, 5)]


def test_few_or_no_vectors(spark):
    assert _search(spark, [(0, [1.0])]) == []
    assert _search(spark, [(1, [1.0])]) == []
    assert _search(spark, []) == []
    assert _search(spark, [(0, []), (1, [])]) == [(0, 1, 1, 0)]


@pytest.mark.parametrize("trial", range(60))
def test_blocks_of_any_shape(monkeypatch, trial):
    rng = np.random.default_rng(trial)
    monkeypatch.setattr(topk, "PART", int(rng.integers(1, 20)))
    n, d, k = (int(rng.integers(a, b)) for a, b in ((0, 60), (1, 8), (1, 12)))
    matrix = rng.integers(-4, 5, (n, d)).astype(float) * (rng.random((n, d)) < 0.7)
    if trial % 3 == 0:
        matrix = np.array([[int(x) * 10**20 for x in r] for r in matrix], object).reshape(matrix.shape)
    ids = rng.permutation(2 * n)[:n].astype(np.int64)
    q = slice(0, n // 2)
    found = topk.search_block(ids, matrix, ids[q], matrix[q], k)
    expected = []
    for i in range(n // 2):
        scores = sorted((-int(matrix[j] @ matrix[i]), int(ids[j])) for j in range(n) if j != i)[:k]
        expected += [(int(ids[i]), s, j) for s, j in scores]
    assert sorted((int(a), -int(s), int(b)) for a, b, s in zip(*found)) == sorted(expected)


def test_components_beyond_the_scaled_range(spark):
    """Finite components whose scaled value is no double any more; scores are held at the limits of a long."""
    rows = [(0, [1.7e308, 0.5]), (1, [1.0, 1.0]), (2, [-1.0, 3.0]), (3, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 2**63 - 1), (3, 1024 * 2048 // 2), (2, -(2**63))]


def test_repeated_rows_lie_in_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 50)
    df = spark.createDataFrame([(7, [0.5, 0.25])] * 400 + [(0, [1.0, 1.0])], "vec_id long, embedding array<double>").repartition(4)
    got = topk.top_k(df, df.where("vec_id = 0"), k=500).collect()
    assert [r.score for r in got] == [1024 * 512 + 1024 * 256] * 400 and {r.vec_id for r in got} == {7}
