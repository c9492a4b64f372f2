"""Lines of few words take part in line dedup, in the query and in the pipeline."""

import random

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_lines_by_row import cleaned, later_lines
from veil.llm import queries


def _short(seed):
    rng = random.Random(seed)
    fixed = ["Read more", "All rights reserved.", "Home", "  Read more ", "\tHome", "", "  ", "a b c d", "a b c d e", "d c b a f", "one two three"]
    line = lambda: rng.choice([*fixed, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 6)))])
    return [(i, "\n".join(line() for _ in range(rng.randint(1, 4)))) for i in range(150)]


def test_short_lines_are_removed(spark, tmp_path):
    rows = _short(1)
    gone = later_lines(rows, 1)
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.text_sha256) for r in got) == sorted((d, brute.sha(t)) for d, t in cleaned(rows, gone))
    assert sum(r.n_removed for r in got) == len(gone)
    staged = corpus_pipeline.distinct_lines(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    assert sorted((str(r.doc_id), r.text) for r in staged.collect()) == sorted(cleaned(rows, gone))


def test_four_words_meet_five(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d"), (2, "a b c d e"), (3, "a b c"), (4, "a b c x")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    got = {r.doc_id: r.n_removed for r in queries.QUERIES["op7_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 0}
