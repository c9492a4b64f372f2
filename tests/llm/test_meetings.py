"""Line dedup: similar lines meet about once, and parity bits of every length let them through."""

import random

import numpy as np
import pyarrow as pa
import pytest

from veil.llm import line_dedup


def _family(seed, n=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(600)]
    texts = []
    for size in (4, 9, 30, 64, 66, 100, 128, 140, 250, 300):
        base = rng.sample(words, size)
        for _ in range(n // 10):
            other = rng.sample(base, size - rng.randint(0, size // 7)) + [f"n{rng.random()}" for _ in range(rng.randint(0, size // 9))]
            texts.append(" ".join(other))
    return texts


def _rows(texts):
    lines = line_dedup.Lines(pa.array(texts), 4)
    counts = np.bincount(line_dedup._count_place(lines.tokens), minlength=1 << line_dedup._COUNT_BITS)
    at = np.arange(len(texts))
    return lines, line_dedup._entries(at, pa.array(at), lines, counts, {}, None)[0]


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("paired", [0, 256])
def test_every_similar_pair_meets(monkeypatch, seed, paired):
    monkeypatch.setattr(line_dedup, "_PAIRED", paired)
    texts = _family(seed)
    _, rows = _rows(texts)
    found = set()
    for cell in range(3):
        own = rows[rows["word"] % 3 == cell]
        x, y, _ = line_dedup.cell_pairs(own, np.full(len(own), 3), 10_000)
        found |= set(zip(own["row"][x].tolist(), own["row"][y].tolist()))
    sets = [set(t.split()) for t in texts]
    # lines of a set that an earlier line has have no entries
    own = [i for i in range(len(sets)) if sets.index(sets[i]) == i]
    similar = {(i, j) for j in own for i in own if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert similar and similar <= found


def test_a_pair_does_not_meet_at_every_word():
    base = [f"w{i}" for i in range(60)]
    _, rows = _rows([" ".join(base), " ".join(base[:-1])])
    shared = np.unique(rows["word"], return_counts=True)
    assert (shared[1] > 1).sum() >= 10
    met = 0
    for word in shared[0]:
        own = rows[rows["word"] == word]
        met += len(line_dedup.cell_pairs(own, np.full(len(own), 3), 8)[0])
    assert 1 <= met <= 2


@pytest.mark.parametrize("seed", range(5))
def test_different_bits(seed):
    texts = _family(seed)
    lines, rows = _rows(texts)
    first = rows[np.unique(rows["row"], return_index=True)[1]]
    tokens = {r: lines.tokens[a : a + n] for r, a, n in zip(lines.text.tolist(), lines.starts.tolist(), lines.sizes.tolist())}
    i, j = (m.ravel() for m in np.meshgrid(np.arange(len(first)), np.arange(len(first))))
    got = line_dedup._different_bits(first, i, j)
    seen = set()
    for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
        small = min(first["size"][a], first["size"][b])
        length = 64 if small <= 64 else 128 if small <= 128 else 256
        other = set(tokens[int(first["row"][a])].tolist()) ^ set(tokens[int(first["row"][b])].tolist())
        flips = np.bincount([t >> 32 & (length - 1) for t in other], minlength=length) & 1
        assert n == flips.sum() <= len(other)
        seen.add(length)
    assert seen == {64, 128, 256}


def test_hashes_of_words():
    words = ["", "a", "a\0", "\0a", "\0", "abcdefgh", "abcdefgh\0", "abcdefghi", "ä" * 32, "ä" * 33, "x" * 5000, "x" * 5001]
    all_of_them = pa.array(["left out", *words], pa.large_string()).slice(1)
    got = line_dedup._hashes(all_of_them)
    assert len(set(got.tolist())) == len(words)
    assert got.tolist() == [int(line_dedup._hashes(pa.array([w], pa.large_string()))[0]) for w in words]
    assert len(line_dedup._hashes(pa.array([], pa.large_string()))) == 0
