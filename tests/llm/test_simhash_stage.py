"""The near-duplicate stage compares documents of linked SimHash fingerprints before it looks for others."""

import random
from collections import Counter

import corpus_pipeline
from tests.llm import brute
from veil.llm import line_dedup, simhash


def _copies(spark, path):
    """Six texts, each followed by copies that differ in the last word; later ones in many words."""
    rng = random.Random(3)
    rows = []
    for k in range(6):
        words = rng.choices([f"w{i}" for i in range(900)], k=800)
        rows += [(100 * k + i, " ".join([*words[:-1], f"end{i}"])) for i in range(5)]
        rows.append((100 * k + 50, " ".join(w if i % 90 else "other" for i, w in enumerate(words))))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(path)
    return rows, spark.read.parquet(path)


def test_pairs_of_linked_fingerprints(spark, tmp_path):
    _, docs = _copies(spark, str(tmp_path / "d"))
    pairs = [(r.x.doc, r.y.doc) for r in simhash.near_pairs(docs, 5).collect()]
    assert len(pairs) > 10 and all(x < y and x // 100 == y // 100 for x, y in pairs)
    assert max(Counter(d for pair in pairs for d in pair).values()) <= 2


def test_linked_documents_are_settled_first(spark, tmp_path, monkeypatch):
    rows, docs = _copies(spark, str(tmp_path / "d"))
    settled, join = [], line_dedup.near_later_lines

    def spy(*args):
        settled.extend(r.line_key.doc for r in args[-1].collect())
        return join(*args)

    monkeypatch.setattr(line_dedup, "near_later_lines", spy)
    got = sorted(r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, str(tmp_path)).collect())
    assert got == [rows[i][0] for i in brute.dissimilar([t for _, t in rows])] == [100 * k for k in range(6)]
    assert len(settled) > 10 and not set(settled) & set(got)
