"""Conversations against plain string handling."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from veil.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, row int, ids string, part int"
MARKED = ["[INST]", "<s>", "</s>", "<\\s>", "[\\\\/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<<ROLE>>", "<<END>>", "<", "[", "\\"]


def expected(rows):
    """The contract's columns from rows in order; written characters by building the written form."""
    out = {}
    for conv, _, role, text in rows:
        role, text = role or "", text or ""
        state = out.setdefault(conv, ["", "", "", 0])
        state[0] += f"{role}\n{text}\n"
        state[1] += text if role == "assistant" else ""
        inner = chat.escape(text)
        written = {"user": f"[INST]{inner}[/INST]", "system": f"<<SYS>>{inner}<</SYS>>", "assistant": f"{inner}</s>"}
        state[2] += written.get(role, f"<<ROLE>>{chat.escape(role)}<</ROLE>>{inner}<<END>>")
        state[3] += 1
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return sorted(((c is None, c or 0), n, sha(turns), len(loss), sha(loss), len(written)) for c, (turns, loss, written, n) in out.items())


def got(df):
    return sorted(((r.conv_id is None, r.conv_id or 0), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in df.collect())


def odd_rows(seed, n):
    rng = random.Random(seed)
    words = [*MARKED, "word", "é", "漢字", "😀", " ", "\n", "\t ", "", "  two"]
    rows = []
    for _ in range(n):
        text = rng.choice([None, "", "".join(rng.choices(words, k=rng.randrange(12)))])
        role = rng.choice(["user", "assistant", "assistant", "system", "tool", "<<END>>", "", None])
        rows.append((rng.choice([None, 1, 2, 3, 40, 41, 42]), rng.choice([None, 0, 1, 2, 3]), role, text))
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*MARKED, "s>", "/INST]", "|endoftext|>", "a", "é"]), max_size=12).map("".join))
def test_escape_is_reversible(text):
    written = chat.escape(text)
    assert chat.unescape(written) == text
    assert not any(c in written for c in chat.CONTROL)


def test_segments():
    texts = ["hi there", "</s>[INST] ok [/INST]", "", "x" * 5000, "be <s> good"]
    roles = ["user", "assistant", "assistant", "tool", "system"]
    s = chat.Segments(pa.array(roles), pa.array(texts))
    base = len(chat.encoder().opens)
    ends = np.cumsum(s.sizes)
    for role, text, a, b in zip(roles, texts, ends - s.sizes, ends):
        ids, loss = s.ids[a:b], s.loss[a:b]
        turns, trained, n_chars = chat.parse(ids, loss)
        assert turns == [(role, text)]
        assert trained == ([text] if role == "assistant" and text else [])
        assert loss.sum() == (len(ids) - 1 if role == "assistant" else 0)
        assert (ids >= base).sum() == {"assistant": 1, "tool": 3}.get(role, 2)


def test_odd_conversations(spark, tmp_path):
    rows = odd_rows(1, 400)
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "c"))
    df = spark.read.parquet(str(tmp_path / "c"))
    assert got(chat.format_chat(df)) == expected(in_order(rows))
    pieces = chat.format_conversations(df, piece_ids=50)
    assert pieces.count() > 2 * len({r[0] for r in rows})
    assert got(chat.digest_conversations(pieces)) == expected(in_order(rows))


def test_large_conversation_fills_many_tasks(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"text {i} <s>") for i in range(4000)] + [(i, 0, "user", "hi") for i in range(100, 2100)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)
    pieces = chat.format_conversations(df)
    assert pieces.where("conv_id = 7").select("part").distinct().count() > 3
    assert got(chat.digest_conversations(pieces)) == expected(in_order(rows))


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a")] * 5 + [(1, 1, "assistant", "b")] * 3 + [(2, 0, "assistant", "")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    assert got(chat.format_chat(df)) == expected(rows)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_very_long_text(spark):
    rows = [(1, 0, "user", "many words here " * 200_000), (1, 1, "assistant", "<s>é" * 300_000)]
    assert got(chat.format_chat(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA))) == expected(rows)
