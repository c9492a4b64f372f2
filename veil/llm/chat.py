"""Conversations as token ids with a loss mask, put together from separately encoded segments.

Each text is encoded by itself; turns are marked by reserved ids above the vocabulary, which no text can
produce. The loss mask is the running sum of a step up at the first id of an assistant's text and a
step down after its last one.

In the written form a user's turn is ``[INST]text[/INST]``, a system's ``<<SYS>>text<</SYS>>``, an
assistant's ``text</s>``, and any other role's ``<<ROLE>>role<</ROLE>>text<<END>>``. Where a text holds a
control string, one backslash is put behind its first character, and one more where there are some
already, so that no control string is left and taking one backslash away gives the text back.

Turns are sorted into range partitions by conversation, turn and place in the table, so the turns of one
large conversation fill many tasks. A conversation is one row, or several pieces if it is long or lies
across the border of two partitions.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.llm.common import column, partitions, stored, text_of
from veil.llm.tokens import BYTE_BPE, encoder, gather, slices

# The marks of the template, in the order of their ids.
MARKS = ["[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "</s>", "<<ROLE>>", "<</ROLE>>", "<<END>>"]
# Strings that no written text may hold as they are: the marks, the start mark of the same family, the end of a document.
CONTROL = [*MARKS, "<s>", "<|endoftext|>"]
OPEN = {"user": 0, "system": 2}
CLOSE = {"user": 1, "system": 3, "assistant": 4}
ROLE, ROLE_END, END = 5, 6, 7
TRAINED = "assistant"
# A conversation with more ids is given in pieces, cut between turns.
PIECE_IDS = 1 << 20
_TAILS = "|".join(sorted((re.escape(c[1:]) for c in CONTROL), key=len, reverse=True))
ESCAPED = rf"([<\[])(\\*)({_TAILS})"
_ESCAPE, _UNESCAPE = re.compile(ESCAPED), re.compile(ESCAPED.replace(r"(\\*)", r"\\(\\*)"))
PIECES = "conv_id long, part int, piece int, open boolean, n_turns long, ids array<int>, loss array<boolean>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def escape(text: str) -> str:
    """The text without control strings."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    """The text that was escaped."""
    return _UNESCAPE.sub(r"\1\2\3", text)


class Segments:
    """The turns of a batch as ids and mask, one after the other."""

    def __init__(self, roles: pa.Array, texts: pa.Array, vocabulary: str = BYTE_BPE):
        coded = encoder(vocabulary)
        base = len(coded.opens)
        names = pc.fill_null(roles, "").to_pylist()
        other = [i for i, r in enumerate(names) if r not in CLOSE]
        odd = pc.match_substring_regex(texts, r"[<\[]").to_numpy(zero_copy_only=False)
        if odd.any():
            values = texts.to_pylist()
            texts = pa.array([escape(t) if o else t for t, o in zip(values, odd)], pa.string())
        content, counts = coded.encode(texts)
        role_ids, role_counts = np.zeros(0, "<u4"), np.zeros(len(names), np.int64)
        if other:
            role_ids, role_counts[other] = coded.encode(pa.array([escape(names[i]) for i in other]))
        is_other = np.zeros(len(names), np.int64)
        is_other[other] = 1
        opened = np.array([OPEN.get(r, ROLE if o else -1) for r, o in zip(names, is_other)], np.int64)
        closed = np.array([CLOSE.get(r, END) for r in names], np.int64)
        trained = np.array([r == TRAINED for r in names], np.int64)
        head = (opened >= 0) + is_other + role_counts
        self.sizes = head + counts + 1
        ends = np.cumsum(self.sizes)
        starts = ends - self.sizes
        self.ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        marked = opened >= 0
        self.ids[starts[marked]] = base + opened[marked]
        first = starts + head
        if other:
            self.ids[gather(np.arange(len(self.ids)), starts[other] + 1, role_counts[other])] = role_ids
            self.ids[first[other] - 1] = base + ROLE_END
        self.ids[gather(np.arange(len(self.ids)), first, counts)] = content
        self.ids[ends - 1] = base + closed
        step = np.zeros(len(self.ids) + 1, np.int8)
        np.add.at(step, first, trained)
        np.add.at(step, first + counts, -trained)
        self.loss = np.cumsum(step[:-1]) > 0


class _Pieces:
    """Collects the turns of consecutive conversations into pieces."""

    def __init__(self, part: int, limit: int):
        self.part, self.limit, self.piece, self.started, self.key = part, limit, 0, False, None
        self.first = True  # the first conversation of a part may have begun in the one before
        self.ids, self.loss, self.turns, self.size = [], [], 0, 0
        self.rows: list[tuple] = []

    def add(self, key, ids: np.ndarray, loss: np.ndarray) -> None:
        if self.started and key != self.key:
            self.close(self.first)
            self.piece, self.first = 0, False
        elif self.started and self.size > self.limit:
            self.close(True)
            self.piece += 1
        self.started, self.key = True, key
        self.ids.append(ids)
        self.loss.append(loss)
        self.turns, self.size = self.turns + 1, self.size + len(ids)

    def close(self, is_open: bool) -> None:
        if self.turns:
            ids, loss = np.concatenate(self.ids), np.concatenate(self.loss)
            self.rows.append((self.key, self.piece, is_open or self.piece > 0, self.turns, ids, loss))
        self.ids, self.loss, self.turns, self.size = [], [], 0, 0

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        offsets = np.concatenate([[0], np.cumsum([len(r[4]) for r in rows])]).astype(np.int32)
        flat = [np.concatenate([r[k] for r in rows]) if rows else np.zeros(0) for k in (4, 5)]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([self.part] * len(rows), pa.int32())]
        columns += [pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.bool_())]
        columns.append(pa.array([r[3] for r in rows], pa.int64()))
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(flat[0], pa.int32())))
        columns.append(pa.ListArray.from_arrays(offsets, pa.array(flat[1], pa.bool_())))
        names = ["conv_id", "part", "piece", "open", "n_turns", "ids", "loss"]
        return pa.RecordBatch.from_arrays(columns, names)


def format_conversations(conversations: DataFrame, vocabulary: str = BYTE_BPE, piece_ids: int = PIECE_IDS) -> DataFrame:
    """Write conversations as ``conv_id, part, piece, open, n_turns, ids, loss`` and read them back.

    The ids of a conversation are those of its pieces by part and piece; a row that is not ``open`` is a
    whole conversation. Turns are in the order of ``turn`` (null first), equal ones in the order of the
    table. Null text and null role are empty; rows with a null conv_id are one conversation. Other columns
    are ignored. An empty table gives no rows.
    """
    turns = conversations.select(
        column("conv_id").cast("long").alias("conv_id"),
        column("turn").cast("long").alias("turn"),
        F.monotonically_increasing_id().alias("row"),
        text_of("role").alias("role"),
        text_of().alias("text"),
    )
    order = ["conv_id", "turn", "row"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(TaskContext.get().partitionId(), piece_ids)
        for batch in batches:
            at = 0
            for part in slices(batch.column("text")):
                segments = Segments(batch.column("role").slice(at, len(part)), part, vocabulary)
                keys = batch.column("conv_id").slice(at, len(part)).to_pylist()
                ends = np.cumsum(segments.sizes)
                for key, a, b in zip(keys, (ends - segments.sizes).tolist(), ends.tolist()):
                    pieces.add(key, segments.ids[a:b], segments.loss[a:b])
                at += len(part)
                if pieces.rows:
                    yield pieces.batch()
        # the last conversation of a part may go on in the next one
        pieces.close(True)
        if pieces.rows:
            yield pieces.batch()

    n = partitions(conversations.sparkSession)
    sorted_turns = turns.repartitionByRange(n, *order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    return stored(sorted_turns.mapInArrow(assemble, PIECES), "chat")


@functools.cache
def _token_bytes(vocabulary: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens one after the other, and where each begins and how long it is."""
    coded = encoder(vocabulary)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    # byte-level vocabularies spell the other bytes as the characters from 256 on
    spelled = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    words = [coded.tokenizer.id_to_token(i) or "" for i in range(len(coded.opens))]
    each = [bytes(spelled[c] for c in w) if all(c in spelled for c in w) else w.encode() for w in words] + [m.encode() for m in MARKS]
    lengths = np.array([len(x) for x in each], np.int64)
    return np.frombuffer(b"".join(each), np.uint8), np.cumsum(lengths) - lengths, lengths


def parse(ids: np.ndarray, loss: np.ndarray, vocabulary: str = BYTE_BPE) -> tuple[list[tuple[str, str]], list[str], int]:
    """The turns of a piece as ``(role, text)``, the text under each run of the mask, and the characters of the written form."""
    flat, starts, lengths = _token_bytes(vocabulary)
    base = len(starts) - len(MARKS)
    sizes = lengths[ids]
    data = gather(flat, starts[ids], sizes).tobytes()
    at = np.concatenate([[0], np.cumsum(sizes)])
    n_chars = len(data.decode())

    def text(a: int, b: int) -> str:
        return unescape(data[at[a] : at[b]].decode())

    turns, begin, role = [], 0, None
    for place in np.flatnonzero(ids >= base).tolist():
        mark = int(ids[place]) - base
        if mark in (OPEN["user"], OPEN["system"], ROLE):
            begin = place + 1
        elif mark == ROLE_END:
            role, begin = text(begin, place), place + 1
        else:
            known = next((r for r, m in CLOSE.items() if m == mark), role)
            turns.append((known, text(begin, place)))
            begin, role = place + 1, None
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
    return turns, [text(a, b) for a, b in edges.reshape(-1, 2).tolist()], n_chars


def digest_conversations(pieces: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Per conversation of written pieces ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Whole conversations are read where they are. Pieces are brought together by conversation and read in
    order with a running digest, so a task holds one batch of them at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, done = None, []
        for batch in batches:
            ids, loss = batch.column("ids"), batch.column("loss")
            flat, masks = ids.flatten().to_numpy(), loss.flatten().to_numpy(zero_copy_only=False)
            edges = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            for i, key in enumerate(batch.column("conv_id").to_pylist()):
                if state is None or state[0] != key:
                    if state:
                        done.append(state)
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns, trained, n_chars = parse(flat[edges[i] : edges[i + 1]], masks[edges[i] : edges[i + 1]], vocabulary)
                state[1] += len(turns)
                for role, text in turns:
                    state[2].update(f"{role}\n{text}\n".encode())
                state[3] += sum(map(len, trained))
                for text in trained:
                    state[4].update(text.encode())
                state[5] += n_chars
            if done:
                yield _digest_rows(done)
                done = []
        if state:
            yield _digest_rows([state])

    whole = pieces.where("NOT open").select("conv_id", "ids", "loss").mapInArrow(run, DIGESTS)
    split = pieces.where("open").repartition(partitions(pieces.sparkSession), "conv_id")
    split = split.sortWithinPartitions("conv_id", "part", "piece").select("conv_id", "ids", "loss")
    return whole.unionByName(split.mapInArrow(run, DIGESTS))


def _digest_rows(states: list) -> pa.RecordBatch:
    rows = [(k, n, turns.hexdigest(), c, loss.hexdigest(), f) for k, n, turns, c, loss, f in states]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)


def format_chat(conversations: DataFrame, vocabulary: str = BYTE_BPE) -> DataFrame:
    """Format conversations and give the digests of what was written (see the two functions before)."""
    return digest_conversations(format_conversations(conversations, vocabulary), vocabulary)
