"""Best-fit packing of documents into sequences of a fixed number of tokens.

Which pieces share a sequence depends on their sizes alone, and there are no more sizes than tokens
in a sequence. So the plan is made from a histogram: "17,204 sequences of one piece of 700 and one of
324". Large pieces, above a third of the capacity, are matched greedily, at most two to a sequence:
each one, from the largest down, with the largest that still fits. Smaller ones, from the largest
down, go to the tightest gap that holds them. Then every piece takes the place that its number
among the pieces of its size has in the plan.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veil.llm.common import column, partitions, stored, text_of
from veil.llm.tokens import BYTE_BPE, encoder, slices

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Segment:
    """``count`` pieces of one size, ``per`` in each of consecutive sequences from ``sequence`` on."""

    size: int
    rank: int
    count: int
    per: int
    sequence: int
    offset: int


class _Bins:
    """A number of sequences that are filled alike."""

    __slots__ = ("count", "gap", "items")

    def __init__(self, count: int, gap: int, items: tuple[tuple[int, int, int], ...]):
        self.count, self.gap, self.items = count, gap, items  # items: size, how many, offset


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Segment]:
    """The places of all pieces, from the number of pieces of each size."""
    left = {s: n for s, n in histogram.items() if n}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError(f"sizes must be between 1 and {capacity}")
    bins = _match_large(left, capacity)
    _best_fit(left, capacity, bins)
    return _segments(bins)


def _match_large(left: dict[int, int], capacity: int) -> list[_Bins]:
    bins = []
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        size = large[-1]
        partner = next((s for s in reversed(large) if s + size <= capacity and (s != size or left[s] > 1)), None)
        if partner is None:
            count, items = left[size], ((size, 1, 0),)
            left[size] = 0
        elif partner == size:
            count, items = left[size] // 2, ((size, 2, 0),)
            left[size] -= 2 * count
        else:
            count, items = min(left[size], left[partner]), ((size, 1, 0), (partner, 1, size))
            left[size] -= count
            left[partner] -= count
        bins.append(_Bins(count, capacity - sum(s * n for s, n, _ in items), items))
        large = [s for s in large if left[s]]
    return bins


def _best_fit(left: dict[int, int], capacity: int, bins: list[_Bins]) -> None:
    by_gap: dict[int, list[_Bins]] = {}
    for b in bins:
        by_gap.setdefault(b.gap, []).append(b)
    bins.clear()
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        todo = left[size]
        gaps = [g for g in by_gap if g >= size]
        heapq.heapify(gaps)
        while todo:
            if not gaps:
                per = min(capacity // size, todo)
                by_gap.setdefault(capacity, []).append(_Bins(-(-todo // per), capacity, ()))
                heapq.heappush(gaps, capacity)
            gap = heapq.heappop(gaps)
            waiting = by_gap.pop(gap)
            while waiting and todo:
                b = waiting.pop()
                # the tightest gap stays the tightest until it holds no more of this size
                per = min(gap // size, todo)
                count = min(b.count, todo // per)
                filled = _Bins(count, gap - per * size, (*b.items, (size, per, capacity - gap)))
                by_gap.setdefault(filled.gap, []).append(filled)
                todo -= per * count
                if count < b.count:
                    waiting.append(_Bins(b.count - count, gap, b.items))
            if waiting:
                by_gap.setdefault(gap, []).extend(waiting)
                heapq.heappush(gaps, gap)
    bins.extend(b for same in by_gap.values() for b in same if b.items)


def _segments(bins: list[_Bins]) -> list[Segment]:
    out, used, sequence = [], {}, 0
    for b in bins:
        for size, per, offset in b.items:
            rank = used.get(size, 0)
            out.append(Segment(size, rank, per * b.count, per, sequence, offset))
            used[size] = rank + per * b.count
        sequence += b.count
    return out


def pieces(docs: DataFrame, vocabulary: str = BYTE_BPE, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document with length and crc32: only documents above the capacity are cut,
    into full pieces from the end, so that the first piece may be shorter. Texts are read once, and no token
    id leaves the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            at = 0
            for part in slices(batch.column(1)):
                ids, counts = encode(part)
                yield _pieces_of(batch.column(0).slice(at, len(part)), ids, counts, capacity, end_id)
                at += len(part)

    return docs.select(column("doc_id").cast("long").alias("doc_id"), text_of()).mapInArrow(cut, PIECES)


def _pieces_of(doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray, capacity: int, end_id: int) -> pa.RecordBatch:
    row, piece, start, length, crc = [], [], [], [], []
    ends = np.cumsum(counts)
    for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
        own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
        first = len(own) % capacity or capacity
        edges = [0, *range(first, len(own) + 1, capacity)]
        for k, (x, y) in enumerate(zip(edges, edges[1:])):
            row.append(i), piece.append(k), start.append(x), length.append(y - x)
            crc.append(zlib.crc32(own[x:y].tobytes()))
    columns = [doc_ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
    columns += [pa.array(c, pa.int64()) for c in (start, length, crc)]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])


def numbered_by_size(items: DataFrame, size: str) -> DataFrame:
    """Add ``rank``: the number of a row among those of its size, from 0.

    Rows are numbered within (size, bucket) and the buckets of a size follow each other, so a
    frequent size is spread over all tasks.
    """
    n = max(64, 2 * partitions(items.sparkSession))
    spread = items.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n)))
    counts = spread.groupBy(size, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # at most sizes x buckets rows
    before = W.partitionBy(size).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(size, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(size, "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = spread.withColumn("_at", F.row_number().over(inside) - 1)
    return ranked.join(offsets, [size, "_bucket"]).withColumn("rank", F.col("_at") + F.col("_before")).drop(
        "_bucket", "_at", "_before"
    )


def pack_pieces(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces that have a ``length``."""
    counts = items.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    # one row per size, of which there are no more than tokens in a sequence
    segments = plan({r["length"]: r["n"] for r in counts.collect()}, capacity)
    segments.sort(key=lambda s: (s.size, s.rank))
    size, rank, per, sequence, offset = (
        np.array([getattr(s, f) for s in segments], np.int64) for f in ("size", "rank", "per", "sequence", "offset")
    )
    firsts = {s: int(np.searchsorted(size, s)) for s in set(size.tolist())}
    lasts = {s: int(np.searchsorted(size, s, "right")) for s in firsts}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            own = batch.column("rank").to_numpy()
            at = np.zeros(len(length), np.int64)
            for s in np.unique(length):
                here = length == s
                at[here] = firsts[s] + np.searchsorted(rank[firsts[s] : lasts[s]], own[here], "right") - 1
            inside = own - rank[at]
            columns = {n: batch.column(n) for n in names}
            columns["sequence_id"] = pa.array(sequence[at] + inside // per[at])
            columns["offset"] = pa.array(offset[at] + inside % per[at] * length)
            yield pa.RecordBatch.from_pydict(columns)

    names = items.columns
    schema = f"{PIECES}, sequence_id long, offset long"
    return numbered_by_size(items, "length").select(*names, F.col("rank").cast("long")).mapInArrow(place, schema)


def best_fit_packing(
    docs: DataFrame, vocabulary: str = BYTE_BPE, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A null text
    is empty and still ends in ``end_id``; rows that repeat a doc_id are documents of their own. No
    documents give no rows. Other columns are ignored.
    """
    return pack_pieces(stored(pieces(docs, vocabulary, capacity, end_id), "pieces"), capacity)
