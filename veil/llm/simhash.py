"""SimHash near-dedup: fingerprints that differ in few bits are found by blocks they share.

A fingerprint is cut into ``BLOCKS`` blocks. Two that differ in at most ``distance`` bits agree in all but
``distance`` blocks, so they meet under at least one choice of the other blocks. Fingerprints that
meet leave ``distance`` blocks open, which bounds a group by the values those can take, whatever the
number of documents; equal fingerprints count as one before. Inside a group every pair within the
distance is verified and the group is linked up, each member to the smallest of its part, so that
a dense group gives no more links than members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import column, partitions, spread_join, stored, text_of
from veil.llm.graph import connected_components

WORDS = 3
DISTANCE = 2
BLOCKS = 6
SEED = 42
_ROW = "_veil_row"
_PART = 1 << 16  # hashes counted at once, so that a very long text needs little memory
# the place of a document among all: null ids last
PLACE = "struct<none: boolean, doc: bigint, line: int, row: bigint>"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: bytes, words: int = WORDS) -> Iterator[np.ndarray]:
    """XXH64 of the word shingles in order, repeats included; white space is ASCII."""
    own = text.translate(_LOWER).split()
    if not own:
        return
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(own) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _PART):
        pairs = zip(starts[at : at + _PART].tolist(), ends[at : at + _PART].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """64 bits, each set if it is set in over half of the hashes; zero without words."""
    votes, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, words):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, hashes: bool = False) -> DataFrame:
    """``row, doc_id, fp``: the place of the row in the table and the fingerprint as a signed 64-bit integer; with ``hashes``
    also ``text_hash``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py(), words) for t in texts], np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(fps.view(np.int64)), *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), column("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    if hashes:
        rows = rows.withColumn("text_hash", F.xxhash64("text"))
    names = ["row", "doc_id", "fp", "text_hash"][: len(rows.columns)]
    return rows.mapInArrow(hashed, ", ".join(f"{n} long" for n in names))


def block_ranges(blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """``(lowest bit, bits)`` of each block."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def close_links(nodes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints ``fp`` within the distance, directly or by others."""
    ranges = block_ranges(blocks)
    left_open = list(combinations(range(blocks), distance))
    masks = [_signed(~sum(((1 << n) - 1) << at for at, n in (ranges[i] for i in open_)) & (2**64 - 1)) for open_ in left_open]
    keys = [F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    # a group holds no more fingerprints than its open blocks have values, 2 ** 22 at most by default
    groups = (
        nodes.select("fp", F.inline(F.array(*keys)))
        .groupBy("choice", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("choice", "fps")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            choices, lists = batch.column(0).to_numpy(), batch.column(1)
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            a, b = [], []
            for i, choice in enumerate(choices):
                fps = np.sort(flat[offsets[i] : offsets[i + 1]].view(np.uint64))
                labels = group_labels(fps, [ranges[k] for k in left_open[choice]], distance)
                own = np.flatnonzero(labels != np.arange(len(fps)))
                a.append(fps[own]), b.append(fps[labels[own]])
            columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)] if a else [pa.array([], pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return groups.mapInArrow(link, "a long, b long")


def group_labels(fps: np.ndarray, open_bits: list[tuple[int, int]], distance: int) -> np.ndarray:
    """The position of the smallest fingerprint that each is connected to, of sorted ones that agree outside
    the open bits. Small groups compare all pairs; large ones look up every flip of the open bits."""
    labels = np.arange(len(fps))
    if len(fps) <= 512:
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
        while True:
            least = np.where(near, labels[None, :], len(fps)).min(axis=1)
            if (least == labels).all():
                return labels
            labels = least
    index, width = np.zeros(len(fps), np.int64), 0
    for at, n in open_bits:
        index |= ((fps >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) << width
        width += n
    place = np.full(1 << width, -1, np.int32)
    place[index] = np.arange(len(fps))
    flips = [sum(1 << b for b in bits) for k in range(1, distance + 1) for bits in combinations(range(width), k)]
    while True:
        before = labels
        labels = labels.copy()
        for flip in flips:
            other = place[index ^ flip]
            labels = np.where(other >= 0, np.minimum(labels, labels[other]), labels)
        labels = labels[labels]
        if (labels == before).all():
            return labels


def _components(rows: DataFrame, distance: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Stored ``fp, root, copies`` and ``root, n, first``: the first row of each component, null ids last."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    nodes = stored(
        rows.groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies")), "distinct-fingerprints"
    )
    found = connected_components(close_links(nodes, distance, blocks)).withColumnRenamed("node", "fp")
    rooted = stored(
        nodes.join(found, "fp", "left").select("fp", "first", "copies", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    return rooted, stored(rooted.groupBy("root").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n")), "parts")


def simhash_dedup(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id that links of at most ``distance`` differing bits lead to.
    A null text is empty and has the fingerprint zero. Rows that repeat a doc_id keep their rows;
    a null doc_id is no candidate for ``component_id``, which is null if there is no other. Other columns are
    ignored.
    """
    rows = stored(fingerprints(docs, words), "fingerprints")
    rooted, parts = _components(rows, distance, blocks)
    known = spread_join(rooted.drop("first"), parts, "root", "n").select("fp", F.col("first.doc_id").alias("component_id"), "copies")
    return spread_join(rows, stored(known, "components"), "fp", "copies").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """The documents, all columns as they are, with one of each component: that of the smallest doc_id.

    ``docs`` is read twice and must give its rows in the same places, as a stored table does; of rows
    that repeat the smallest doc_id the first stays.
    """
    rows = stored(fingerprints(docs, words), "fingerprints")
    kept = _components(rows, distance, blocks)[1].select(F.col("first.row").alias(_ROW))
    placed = docs.withColumn(_ROW, F.monotonically_increasing_id())
    return placed.join(kept.hint("shuffle_hash"), _ROW, "left_semi").drop(_ROW)


def near_pairs(docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Pairs ``x, y`` of documents to compare, ``x`` the earlier, as ``PLACE``: neighbours in each component of fingerprints,
    ordered by fingerprint and place. Of equal texts the first takes part.

    So no document is in more than two pairs, and pairs link each component up, also across the borders of tasks.
    """
    spark = docs.sparkSession
    rows = stored(fingerprints(docs, words, hashes=True), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("doc"), F.lit(0).alias("line"), "row")
    texts = rows.groupBy("fp", "text_hash").agg(F.min(place).alias("place"))
    rooted = _components(rows, distance, blocks)[0].select("fp", "root", "copies")
    order = ["root", "fp", "place"]
    dealt = spread_join(texts, rooted, "fp", "copies").select(*order).repartitionByRange(partitions(spark), *order)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.slice(0, 1) if first is None else first
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            last = batch.slice(batch.num_rows - 1)
            root, places = batch.column(0).to_numpy(), batch.column(1)
            own = np.flatnonzero(root[1:] == root[:-1])
            none = [pa.nulls(len(own), t) for t in (pa.int64(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([places.take(pa.array(own)), places.take(pa.array(own + 1)), *none], names)
        if first is not None:
            ends = [first.column(1), last.column(1), first.column(0), last.column(0), first.column(2)]
            yield pa.RecordBatch.from_arrays(ends, names)

    # rows of a ``task`` hold its first and its last text with their components, other rows a pair
    names = ["a", "b", "first_root", "last_root", "task"]
    ranges = dealt.sortWithinPartitions(*order).select("root", "place", F.spark_partition_id().alias("task"))
    both = stored(ranges.mapInArrow(pair, f"a {PLACE}, b {PLACE}, first_root long, last_root long, task int"), "linked-texts")
    # one row a task
    ends = sorted(both.where("task IS NOT NULL").collect(), key=lambda r: r.task)
    across = [(tuple(x.b), tuple(y.a)) for x, y in zip(ends, ends[1:]) if x.last_root == y.first_root]
    pairs = both.where("task IS NULL").select("a", "b").unionByName(spark.createDataFrame(across, f"a {PLACE}, b {PLACE}"))
    return pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x
