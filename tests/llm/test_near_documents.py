"""The near-duplicate stage against brute-force Jaccard of five-word shingles."""

import random

import pyarrow as pa

import corpus_pipeline
from tests.llm import brute
from veil.llm import line_dedup


def test_near_copies_go(spark, tmp_path):
    rng = random.Random(9)
    base = [rng.choices([f"w{i}" for i in range(300)], k=rng.choice([3, 4, 5, 8, 9, 60, 200])) for _ in range(14)]
    rows = [(None, None), (None, ""), (50, " \n"), (51, "one"), (52, "\tOne "), (53, "four words are here"), (53, "four words are here")]
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(["new", "other", "W7"])
        rows.append((rng.choice([100 + i, 300 - i, None]), rng.choice(["", "\n"]) + rng.choice([" ", "\n"]).join(words)))
    spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n int").coalesce(2).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    stored = docs.collect()
    order = sorted(range(len(stored)), key=lambda i: (stored[i].doc_id is None, stored[i].doc_id or 0, i))
    kept = [stored[order[i]].n for i in brute.dissimilar([stored[i].text for i in order])]
    got = corpus_pipeline.distinct_documents(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(r.n for r in got.collect()) == sorted(kept)


def test_changed_words_in_long_copies(spark, tmp_path):
    """Copies with a few per cent of changed words, far over two bits of SimHash apart."""
    rng = random.Random(2)
    text = rng.choices([f"v{i}" for i in range(2000)], k=500)
    rows = []
    for i in range(40):
        words = list(text)
        for at in range(i % 13, 500, 125):
            words[at] = f"c{i}"
        rows.append((i, " ".join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    assert [r.doc_id for r in corpus_pipeline.distinct_documents(spark, spark.read.parquet(str(tmp_path / "d")), str(tmp_path)).collect()] == [0]


def test_batches_of_several_slices(spark, tmp_path):
    """A batch of more bytes than one slice: every part after the first begins at an offset."""
    rng = random.Random(4)
    vocabulary = [f"Wört{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=20_000) for _ in range(45)]
    texts = []
    for i in range(90):
        words = list(base[i % 45])
        for _ in range(0 if i < 45 else 1):
            words[rng.randrange(len(words))] = "other"
        texts.append(" ".join(words))
    assert sum(map(len, texts)) > 4 * line_dedup._PART_BYTES
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    docs.write.parquet(str(tmp_path / "d"))
    got = corpus_pipeline.distinct_documents(spark, spark.read.parquet(str(tmp_path / "d")), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == brute.dissimilar(texts)


def test_shingles_of_every_slice():
    texts = pa.array([f"A{i} b c D{i % 7} e f{i}" for i in range(40)] + ["", "ÄB cd", "Ü \t é"] * 5)
    for at in range(0, len(texts), 9):
        part = texts.slice(at, 9)
        sliced, copied = line_dedup.Shingles(part, 1, 5), line_dedup.Shingles(pa.array(part.to_pylist()), 1, 5)
        assert sliced.tokens.tolist() == copied.tokens.tolist()
        assert sliced.text.tolist() == copied.text.tolist()
