"""Longer parity vectors and filter tables of line dedup: they let every similar pair through."""

import random

import numpy as np
import pyarrow as pa
import pytest

from veil.llm import line_dedup


@pytest.mark.parametrize("seed", range(20))
def test_similar_long_lines_pass(seed):
    rng = random.Random(seed)
    n = rng.choice([66, 100, 127, 128, 129, 250, 1000, 5000])
    base = [f"b{seed}w{i}" for i in range(n)]
    # the least similar set that still counts, smaller or larger, or with as many words replaced
    fewer, more, other = base[: -(-4 * n // 5)], [*base, *(f"m{i}" for i in range(n // 4))], [*base[n // 9 :], *(f"o{i}" for i in range(n // 9))]
    unlike = [f"u{i}" for i in range(n)]
    texts = pa.array([" ".join(rng.sample(t, len(t))) for t in (base, fewer, more, other, unlike)] + ["short line", ""])
    lines = line_dedup.Lines(texts, 1)
    wide = lines.wide()
    # 64 words and fewer have none
    assert [w is None for w in wide] == [s <= line_dedup._NARROW_WORDS for s in lines.sizes.tolist()]
    sets = [set(t.split()) for t in texts.to_pylist()]
    for i in range(5):
        for j in range(5):
            if wide[i] is None or wide[j] is None:
                continue
            may = line_dedup._may_be_similar(int(lines.sizes[i]), wide[i], int(lines.sizes[j]), wide[j])
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                assert may
            elif 4 in (i, j):
                assert not may


def test_filter_has_every_key(spark):
    keys = spark.range(5000).selectExpr("named_struct('none', false, 'doc', id, 'line', int(id % 7), 'row', id * 3) AS line_key")
    table = line_dedup._line_filter(keys)
    every = np.arange(5000, dtype=np.int64)
    assert line_dedup._among(table, line_dedup._hash((every % 7).astype(np.int32), every * 3)).all()
    others = line_dedup._among(table, line_dedup._hash((every % 7).astype(np.int32), every * 3 + 1))
    assert others.mean() < 0.05
    assert not line_dedup._among(line_dedup._line_filter(keys.limit(0)), line_dedup._hash(every.astype(np.int32), every)).any()
