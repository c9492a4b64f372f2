"""Token-id files: blocks of ids, coded by an adaptive context-mixing range coder.

A block holds whole documents and starts with a fresh model. Its ids are laid out in lanes, which are
coded side by side with one shared model, so that numpy works on all lanes at once. For each id
there are three predictions: the id that followed the last two ids before, the one that followed
the last id, and the frequencies of all ids. The first two get shares of the probability by how
often predictions of the same standing came true in the block so far; the rest goes to the
frequencies. A range coder codes the id in that mixture, and the decoder repeats every step.

Layout of a block, little-endian: magic, version, numbers of documents, ids, lanes and vocabulary,
crc32 of the ids, then the document ids and lengths (deflated), the number of 16-bit words of each
lane, the words, and the crc32 of all that. A file is a Parquet file of blocks in order, so that Spark's
committers place it on any store.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veil.llm.common import column, partitions, text_of
from veil.llm.tokens import BYTE_BPE, encoder, slices

END_ID = 0
BLOCK_IDS = 1 << 21
LANES, STEPS = 4096, 256
MAGIC, VERSION = b"VEILIDS\0", 1
_HEAD = struct.Struct("<8sIIQIII")
_UNIT, _SLOTS = 24, 20  # probabilities in 2**-24; the frequencies share 2**20 slots
_LEVEL_BITS = 4
_LEVELS = 1 << _LEVEL_BITS
_CONTEXTS = 20
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
BLOCKS = "file int, block int, before long, n_ids long, block_bytes binary"


class _Model:
    """What is known in a block before the next step: the same for coder and decoder."""

    def __init__(self, vocabulary: int, lanes: int):
        self.size = vocabulary
        self.kind = np.int32 if vocabulary < (1 << 31) // _LEVELS else np.int64
        self.counts = vocabulary // (np.arange(vocabulary) + 16) + 1  # low ids are the frequent ones
        # the id that followed and, in the lowest bits, how far it is trusted: one look into memory tells both
        self.follow1, self.follow2 = np.zeros(vocabulary, self.kind), np.zeros(1 << _CONTEXTS, self.kind)
        self.events = np.tile(np.array([1, 1, 2], np.int64), (2 * _LEVELS * _LEVELS, 1))
        self.last1, self.last2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step, self.counted, self.fresh = 0, 0, []

    def renew(self, grid: np.ndarray) -> bool:
        """Bring shares and frequencies up to date with the steps so far, now and then; tells whether the latter changed."""
        step = self.step
        doubled = not step & (step - 1)
        if doubled or not step % 8:
            if self.fresh:
                met = np.bincount(np.concatenate(self.fresh), minlength=self.events.size)
                self.events += met.reshape(self.events.shape)
                self.fresh = []
            # by how often each state came true; the frequencies always keep one unit per slot
            scale = (self.events[:, :2] * ((1 << _UNIT) - (1 << _SLOTS))) // self.events.sum(axis=1, keepdims=True)
            self.shares = np.ascontiguousarray(scale.T).astype(np.uint64)
        if not doubled and step % 64:
            return False
        if step:
            self.counts = self.counts + np.bincount(grid[self.counted : step].ravel(), minlength=self.size)
        self.counted = step
        share = 1 + self.counts * ((1 << _SLOTS) - self.size) // self.counts.sum()
        self.bounds = np.concatenate([[0], np.cumsum(share)]).astype(np.uint64)
        return True

    def predict(self) -> None:
        self.context = ((self.last1 * 0x9E3779B1 + self.last2 * 0x85EBCA77) >> 11) & ((1 << _CONTEXTS) - 1)
        both2, both1 = self.follow2.take(self.context), self.follow1.take(self.last1)
        self.guess2, self.guess1 = both2 >> _LEVEL_BITS, both1 >> _LEVEL_BITS
        self.know2, self.know1 = both2 & (_LEVELS - 1), both1 & (_LEVELS - 1)
        self.state = (self.know2 * _LEVELS + self.know1) * 2 + (self.guess1 == self.guess2)
        self.share2 = self.shares[0].take(self.state)
        self.guessed = self.share2 + self.shares[1].take(self.state)
        self.rest = np.uint64(1 << _UNIT) - self.guessed

    def interval(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.uint64(_SLOTS)
        low = self.guessed + ((self.bounds.take(ids) * self.rest) >> at)
        high = self.guessed + ((self.bounds.take(ids + 1) * self.rest) >> at)
        for hit, first, end in ((hit1, self.share2, self.guessed), (hit2, None, self.share2)):
            own = np.flatnonzero(hit)
            low[own] = first.take(own) if first is not None else 0
            high[own] = end.take(own)
        return low, high - low

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        self.fresh.append(self.state * 3 + 2 - hit1 - 2 * hit2)
        # one more level when right, the first level when wrong
        followed = ids.astype(self.kind) * _LEVELS + 1
        self.follow2[self.context] = followed + np.minimum(self.know2, _LEVELS - 2) * hit2
        self.follow1[self.last1] = followed + np.minimum(self.know1, _LEVELS - 2) * (self.guess1 == ids)
        self.last2, self.last1 = self.last1, ids
        self.step += 1


def encode_ids(ids: np.ndarray, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """``(words per lane, words)`` of a block's ids."""
    grid = _grid(ids)
    steps, lanes = grid.shape
    model = _Model(vocabulary, lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 1 << 63, np.uint64)
    width = 2 * steps + 16
    out, at = np.zeros((lanes, width), np.uint16), np.zeros(lanes, np.int64)
    firsts = np.arange(lanes) * width
    for own in grid:
        model.renew(grid)
        model.predict()
        hit2 = own == model.guess2
        hit1 = (own == model.guess1) & ~hit2
        start, part = model.interval(own, hit2, hit1)
        unit = span >> np.uint64(_UNIT)
        low += unit * start
        span = unit * part
        if at.max() + 8 > width:
            out, width = np.hstack([out, np.zeros_like(out)]), 2 * width
            firsts = np.arange(lanes) * width
        flat = out.reshape(-1)
        for lane, moved in _renormalise(low, span):
            flat[firsts[lane] + at[lane]] = moved >> np.uint64(48)
            at[lane] += 1
        model.update(own, hit2, hit1)
    # the smallest multiple of 2**32 that is not below the low end ends each lane; zeros follow it
    end = (low + (_BOTTOM - np.uint64(1))) >> np.uint64(32)
    rows = np.arange(lanes)
    out[rows, at], out[rows, at + 1] = end >> np.uint64(16), end & np.uint64(0xFFFF)
    at += 2
    return at.astype("<u4"), out[np.arange(width) < at[:, None]].astype("<u2")


def decode_ids(n: int, lanes: int, vocabulary: int, sizes: np.ndarray, words: np.ndarray) -> np.ndarray:
    steps = -(-n // lanes)
    grid = np.zeros((steps, lanes), np.int64)
    # zeros stand after the end of each lane
    width = int(sizes.max()) + 8
    source = np.zeros((lanes, width), np.uint16)
    source[np.arange(width) < sizes[:, None]] = words
    firsts, at = np.arange(lanes) * width, np.full(lanes, 4, np.int64)
    code = np.zeros(lanes, np.uint64)
    for i in range(4):
        code = (code << np.uint64(16)) | source[:, i]
    flat = source.reshape(-1)
    model = _Model(vocabulary, lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 1 << 63, np.uint64)
    for step in range(steps):
        if model.renew(grid):
            slots = np.repeat(np.arange(vocabulary, dtype=model.kind), np.diff(model.bounds.astype(np.int64)))
        model.predict()
        unit = span >> np.uint64(_UNIT)
        target = (code - low) // unit
        beyond = np.maximum(target, model.guessed) - model.guessed
        slot = (((beyond + np.uint64(1)) << np.uint64(_SLOTS)) - np.uint64(1)) // model.rest
        own = slots.take(slot.view(np.int64), mode="clip").astype(np.int64)
        hit2 = target < model.share2
        hit1 = (target < model.guessed) & ~hit2
        for hit, guess in ((hit1, model.guess1), (hit2, model.guess2)):
            lane = np.flatnonzero(hit)
            own[lane] = guess.take(lane)
        start, part = model.interval(own, hit2, hit1)
        low += unit * start
        span = unit * part
        for lane, _ in _renormalise(low, span):
            place = at.take(lane)
            word = flat.take(firsts.take(lane) + np.minimum(place, width - 1))
            code[lane] = (code.take(lane) << np.uint64(16)) | word
            at[lane] = place + 1
        grid[step] = own
        model.update(own, hit2, hit1)
    return np.ascontiguousarray(grid.T, np.uint32).ravel()[:n]


def _renormalise(low: np.ndarray, span: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Widen narrow spans: lanes whose first 16-bit word is settled, with their low ends, again and again."""
    own_low, own_span, lane = low, span, None
    while True:
        settled = (own_low ^ (own_low + own_span)) < _TOP
        here = np.flatnonzero(settled | (own_span < _BOTTOM))
        if not len(here):
            return
        # a short span whose first word is open is cut at the next multiple of 2**32
        own_low, own_span, settled = own_low.take(here), own_span.take(here), settled.take(here)
        if not settled.all():
            own_span = np.where(settled, own_span, (np.uint64(0) - own_low) & (_BOTTOM - np.uint64(1)))
        lane = here if lane is None else lane.take(here)
        yield lane, own_low
        own_low, own_span = own_low << np.uint64(16), own_span << np.uint64(16)
        low[lane], span[lane] = own_low, own_span


def _grid(ids: np.ndarray) -> np.ndarray:
    """One row per step, one column per lane; lanes are consecutive parts of the ids."""
    lanes = max(1, min(LANES, len(ids) // STEPS))
    steps = -(-len(ids) // lanes)
    padded = np.zeros(lanes * steps, np.int64)
    padded[: len(ids)] = ids
    return np.ascontiguousarray(padded.reshape(lanes, steps).T)


def write_block(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    """The bytes of a block."""
    names = np.array([(0, 0) if d is None else (1, d) for d in doc_ids], np.int64).reshape(-1, 2)
    index = zlib.compress(names[:, 0].astype("<i1").tobytes() + names[:, 1].astype("<i8").tobytes() + lengths.astype("<u8").tobytes(), 1)
    lanes = max(1, min(LANES, len(ids) // STEPS))
    sizes, words = encode_ids(ids, vocabulary)
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    body = _HEAD.pack(MAGIC, VERSION, len(doc_ids), len(ids), lanes, vocabulary, crc) + struct.pack("<I", len(index)) + index
    body += sizes.tobytes() + words.tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def read_block(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """``(document ids, lengths, ids)`` of a block; an error if any byte of it has changed."""
    if len(data) < _HEAD.size + 8 or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
        raise ValueError("damaged block")
    magic, version, docs, n, lanes, vocabulary, crc = _HEAD.unpack_from(data)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of this version")
    (size,) = struct.unpack_from("<I", data, _HEAD.size)
    at = _HEAD.size + 4
    index = zlib.decompress(data[at : at + size])
    there = np.frombuffer(index, "<i1", docs)
    names = np.frombuffer(index, "<i8", docs, docs)
    lengths = np.frombuffer(index, "<u8", docs, 9 * docs).astype(np.int64)
    at += size
    sizes = np.frombuffer(data, "<u4", lanes, at)
    words = np.frombuffer(data, "<u2", int(sizes.sum()), at + 4 * lanes)
    ids = decode_ids(n, lanes, vocabulary, sizes, words)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("block does not decode to its ids")
    return [int(d) if t else None for t, d in zip(there, names)], lengths, ids


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str = BYTE_BPE, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Encode all documents in ascending doc_id order, each followed by ``end_id``, into files at ``path``.

    A null text is empty; a null doc_id comes first. Rows that share a doc_id are documents of their
    own, ordered by a hash of their text, which also splits a frequent id over files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokens = encoder(vocabulary)
        size = max(tokens.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        file, block, before = TaskContext.get().partitionId(), 0, 0
        names, lengths, parts, waiting = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            data = write_block(names, np.array(lengths, np.int64), ids, size)
            row = {"file": [file], "block": [block], "before": [before], "n_ids": [len(ids)], "block_bytes": [data]}
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))

        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                ids, counts = tokens.encode(texts)
                ends = np.cumsum(counts)
                for i, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist())):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype(np.uint32)
                    if waiting and waiting + len(own) > block_ids:
                        yield flush()
                        block, before = block + 1, before + waiting
                        names, lengths, parts, waiting = [], [], [], 0
                    names.append(batch.column(0)[at + i].as_py())
                    lengths.append(len(own)), parts.append(own)
                    waiting += len(own)
                at += len(texts)
        if waiting:
            yield flush()

    order = [F.col("doc_id"), F.col("_tie")]
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    dealt.select("doc_id", "text").mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, checked against their checksums."""
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names, lengths, ids = read_block(data)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                columns = [pa.array(np.full(len(names), file, np.int32)), pa.array(names, pa.int64())]
                columns += [pa.array(x, pa.int64()) for x in (before + ends - lengths, lengths, crcs)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "inside", "n_tokens", "ids_crc32"])

    # one row per file, which is one range partition
    sizes = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))
    rows = blocks.select("file", "before", "block_bytes").mapInArrow(
        run, "file int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    )
    return rows.join(offsets, "file").select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
