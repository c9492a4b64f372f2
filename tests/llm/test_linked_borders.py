"""Every two neighbouring texts of linked fingerprints are a pair, wherever the ranges of tasks end."""

import random
from collections import Counter

from tests.llm import brute
from veil.llm import simhash


def test_pairs_across_tasks(spark, tmp_path):
    rng = random.Random(8)
    rows = [(0, None), (None, "one text alone"), (1, "one text alone")]
    for k in range(1, 4):
        words = rng.choices([f"w{i}" for i in range(900)], k=700)
        rows += [(100 * k + i, " ".join([*words[:-1], f"end{i}"])) for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    texts = sorted({t or "" for _, t in rows})
    fps = [simhash.fingerprint(t.encode(), 5) for t in texts]
    sizes = Counter(brute.components(len(texts), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= simhash.DISTANCE))
    linked = sum(n - 1 for n in sizes.values())
    assert linked > 20
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 5, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found = [(r.x.doc, r.y.doc) for r in simhash.near_pairs(docs, 5).collect()]
            assert len(found) == len(set(found)) == linked
            assert all(x < y and x // 100 == y // 100 for x, y in found)
            assert max(Counter(d for pair in found for d in pair).values()) <= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
