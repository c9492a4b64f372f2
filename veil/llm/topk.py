"""Exact top-k search by inner product, with MaxScore over blocks of vectors.

A vector's components are read as postings: dimension ``d`` has a list of the vectors that are
positive there and one of those that are negative, so for a query one of the two lists can only
raise a score and the other only lower it. Raising lists, from the weakest bound up, are
non-essential as long as their bounds together stay below the k-th score so far: a vector found
in none of the essential lists cannot reach it. The essential lists are traversed, for all queries
of a block at once, and the others probed in falling order of their bounds while a vector is still
competitive.

Vectors and queries are dealt into blocks; every query block meets every vector block in a task
of bounded size, and the best of the blocks are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veil.llm.common import column, stored

SCALE = 1024
K = 10
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024
PART = 1024
FOUND = "query_id long, vec_id long, score long"
_EXACT = 2.0**52  # products up to here are summed as doubles without loss


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vector`` without vectors that are null or hold null or non-finite components."""
    v = column(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vectors.select(column(vec_id).cast("long").alias("vec_id"), v.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad
    )


class Postings:
    """The posting lists of a block of integer vectors: per dimension those above and those below zero.

    Row ``d`` holds the amounts of the vectors that are positive in dimension ``d``, row ``D + d`` those of the
    negative ones; a zero means that a vector is not in the list.
    """

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        self.ids, self.matrix = ids, matrix
        self.amounts = np.ascontiguousarray(np.hstack([np.maximum(matrix, 0), np.maximum(-matrix, 0)]).T)
        self.most = self.amounts.max(axis=1)

    def competitive(self, queries: np.ndarray, least: np.ndarray) -> list[np.ndarray]:
        """For each query the places of the vectors that can still reach ``least``, its k-th score so far."""
        weights = np.hstack([np.maximum(queries, 0), np.maximum(-queries, 0)])
        bounds = weights * self.most
        order = np.argsort(bounds, axis=1, kind="stable")
        weakest = np.take_along_axis(bounds, order, axis=1)
        reach = np.cumsum(weakest, axis=1)
        # lists whose bounds together stay below the k-th score are not traversed
        skipped = reach < least[:, None]
        counts = skipped.sum(axis=1)
        essential = np.ones_like(skipped)
        np.put_along_axis(essential, order, ~skipped, axis=1)
        rest = np.where(counts > 0, np.take_along_axis(reach, np.maximum(counts - 1, 0)[:, None], axis=1)[:, 0], 0)
        upper = (weights * essential) @ self.amounts + rest[:, None]
        found = []
        for i, (row, enough) in enumerate(zip(upper, least)):
            at = np.flatnonzero(row >= enough)
            score = row[at]
            for j in range(counts[i] - 1, -1, -1):  # the strongest of the others first
                if not len(at):
                    break
                d = order[i, j]
                if not weakest[i, j]:
                    break
                score = score + weights[i, d] * self.amounts[d, at] - weakest[i, j]
                still = score >= enough
                at, score = at[still], score[still]
            found.append(at)
        return found


def search_block(ids: np.ndarray, matrix: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """``(query id, vector id, score)`` arrays of the best k per query within one block."""
    best = [(ids[:0], matrix[:0].sum(axis=1)) for _ in query_ids]
    least = np.full(len(query_ids), -np.inf, matrix.dtype)
    at = 0
    while at < len(ids) and len(query_ids):
        step = PART if at else max(k + 1, PART // 8)  # a few vectors first, for a k-th score to compare with
        part = Postings(ids[at : at + step], matrix[at : at + step])
        at += step
        for i, places in enumerate(part.competitive(queries, least)):
            places = places[part.ids[places] != query_ids[i]]
            if not len(places):
                continue
            known, score = best[i]
            known, score = np.append(known, part.ids[places]), np.append(score, part.matrix[places] @ queries[i])
            order = np.lexsort((known, -score))[:k]
            best[i] = known[order], score[order]
            if len(order) == k:
                least[i] = best[i][1][-1]
    if not best:
        return [ids[:0]] * 3
    owners = np.repeat(query_ids, [len(b[0]) for b in best])
    return [owners, np.concatenate([b[0] for b in best]), np.concatenate([b[1] for b in best])]


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as the rows of a matrix; shorter ones are filled up with zeros."""
    flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _exactly(x: float, scale: int) -> int:
    """floor(scale * x); a double this large is an integer, whose multiple may be larger than any double."""
    return int(x) * scale if abs(x) >= 2**52 else int(np.floor(x * scale))


def _block_of(pair: pa.Table, k: int, scale: int) -> pa.Table:
    lists = pair.column("vector").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    width = max([1, *np.diff(lists.offsets.to_numpy())])
    values = _matrix(lists, width)
    with np.errstate(over="ignore"):
        matrix = np.floor(scale * values)
    if width and not np.abs(matrix).max() <= (_EXACT / width) ** 0.5:
        matrix = np.array([[_exactly(x, scale) for x in row] for row in values.tolist()], object).reshape(matrix.shape)
    ids = pair.column("vec_id").to_numpy()
    asks = pair.column("asks").to_numpy(zero_copy_only=False)
    q, v, score = search_block(ids[~asks], matrix[~asks], ids[asks], matrix[asks], k)
    top = 2**63 - 1
    scores = [max(-top - 1, min(top, int(s))) for s in score.tolist()]
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(scores, pa.int64())})


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    scale: int = SCALE,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k highest inner products of each query: ``query_id, rank, vec_id, score``.

    Components become ``floor(scale * x)``. A query's own id is no candidate; ties go to the smaller
    vec_id. Vectors that are null or hold null or non-finite components, and null ids, take no part.
    Shorter vectors count as filled up with zeros, repeated rows as rows of their own among the
    candidates and once among the queries; scores beyond a long are held at its limits. No queries or no other vectors give no rows. Other columns are ignored.
    """
    found = stored(usable(vectors, vec_id, vector).withColumn("row", F.monotonically_increasing_id()), "vectors")
    asked = stored(usable(queries, vec_id, vector).dropDuplicates(), "queries")
    v_blocks, q_blocks = (max(1, -(-df.count() // size)) for df, size in ((found, VECTOR_BLOCK), (asked, QUERY_BLOCK)))
    # by the place in the table, so that repeated rows lie in all blocks
    own = F.pmod(F.xxhash64("row"), F.lit(v_blocks)).cast("int")
    others = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(q_blocks)).cast("int")
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (v_blocks, q_blocks)]
    dealt = found.select(
        "vec_id", "vector", F.lit(False).alias("asks"), own.alias("v"), every[1].alias("q")
    ).unionByName(asked.select("vec_id", "vector", F.lit(True).alias("asks"), every[0].alias("v"), others.alias("q")))

    def search(pair: pa.Table) -> pa.Table:
        return _block_of(pair, k, scale)

    best = dealt.groupBy("v", "q").applyInArrow(search, FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
