"""Line dedup of rows that share a doc_id or have none, and the registered query."""

import random

from tests.llm import brute
from veil.llm import line_dedup, queries


def later_lines(rows, min_words):
    """``(row, line)`` of lines with an earlier similar line; the row decides between equal ids and line numbers."""
    lines = [(r, (d is None, d or 0, k, r), frozenset(x.lower().split())) for r, (d, t) in enumerate(rows) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if len(x[2]) >= min_words]
    return {(r, o[2]) for r, o, w in lines if any(o2 < o and 5 * len(w & w2) >= 4 * len(w | w2) for _, o2, w2 in lines)}


def cleaned(rows, gone):
    return [(str(d), None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (r, k) not in gone)) for r, (d, t) in enumerate(rows)]


def _shared(seed=6):
    rng = random.Random(seed)
    base = [rng.choices([f"w{i}" for i in range(40)], k=rng.randint(6, 20)) for _ in range(12)]
    line = lambda: " ".join([*rng.choice(base)[:-1], rng.choice(["x", "y", "z"])])
    return [(rng.choice([None, None, 1, 1, 2, 3 + i]), "\n".join(line() for _ in range(rng.randint(1, 4)))) for i in range(120)]


def test_rows_that_share_an_id_are_kept_apart(spark):
    rows = _shared()
    gone = later_lines(rows, 5)
    got = line_dedup.line_dedup(brute.frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(cleaned(rows, gone))
    assert all(r.n_removed <= r.n_lines for r in got)
    numbers = line_dedup.later_lines(brute.frame(spark, rows)).collect()
    expected = [(str(d), sorted(k for r2, k in gone if r2 == r)) for r, (d, _) in enumerate(rows)]
    assert sorted((str(r.doc_id), r.removed) for r in numbers) == sorted(expected)


def test_equal_lines_of_rows_without_id(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (7, "f g h i j"), (7, "f g h i j")]
    got = line_dedup.line_dedup(brute.frame(spark, rows)).collect()
    assert sorted(r.text for r in got) == ["", "", "a b c d e", "f g h i j"]


def test_query_gives_the_cleaned_texts(spark, tmp_path):
    rows = _shared(8)
    brute.frame(spark, rows).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    stored = [(r.doc_id, r.text) for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()]
    got = queries.QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()
    expected = [(d, brute.sha(t)) for d, t in cleaned(stored, later_lines(stored, 5))]
    assert sorted((str(r.doc_id), r.text_sha256) for r in got) == sorted(expected)
