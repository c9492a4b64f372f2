"""Language, quality and licence classifiers: what must hold exactly, and held-out accuracy."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veil.llm import language, licenses, quality

SF = "/root/testdata/sf0.01"
WORDS = {
    "xx": "barka dorum felti gravos hinta jolkas mirto nuvela porta quelis".split(),
    "yy": "schwert zwirn knopf pflanze strumpf dampf wurst kranz spross zopf".split(),
}
ODD = [(900, None), (901, ""), (902, "123 !? 456"), (903, "中文字"), (904, "word " * 60_000), (None, "barka dorum")]


def _docs(spark, n=300):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        rows.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 200))), lang, "s", 1))
    rows += [(d, t, None, None, None) for d, t in ODD] + rows[:3]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")


def test_language_of_invented_words(spark):
    docs = _docs(spark)
    got = language.identify_language(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == docs.count()
    held_out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 4 == 2
    assert all(r.held_out == held_out(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {900, 901, 902}
    judged = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out and truth[r.doc_id]]
    assert np.mean(judged) > 0.97


def test_language_learns_from_nothing_else(spark):
    """Held-out rows, other columns and the order of rows change no prediction."""
    docs = _docs(spark)
    held = language.held_out(F.col("doc_id"))
    changed = docs.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert key(language.identify_language(docs)) == key(language.identify_language(changed.orderBy(F.desc("doc_id"))))


def test_language_without_labels(spark):
    docs = _docs(spark, 20).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.identify_language(docs).collect()} == {("und", 0.0)}
    assert language.identify_language(docs.limit(0)).count() == 0
    assert language.keep_identified(docs, language.fit(docs)).count() == 0


def test_pair_tables_are_the_convolution():
    rng = np.random.default_rng(2)
    filters = {w: rng.normal(size=(w, 256, 4)).astype(np.float32) for w in (1, 2, 3, 4)}
    net = language.Network(["a"], filters, np.zeros(16, np.float32), np.zeros((16, 1)), np.zeros(1))
    windows = rng.integers(0, 256, (70, language.WINDOW)).astype(np.uint8)
    plain = []
    for w, t in filters.items():
        n = language.WINDOW - w + 1
        plain.append(sum(t[k][windows[:, k : k + n]] for k in range(w)).max(axis=1))
    assert np.allclose(language.features(net.pair_tables(), net.bias, windows), np.maximum(np.hstack(plain), 0), atol=1e-4)


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = language.fit(docs)
    judged = language.with_language(docs, network).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97
    kept = language.keep_identified(docs, network)
    assert kept.columns == docs.columns
    assert kept.count() > 0.99 * docs.count()


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    teach = labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 3 > 0")
    model = quality.fit(docs, teach)
    judged = quality.score_quality(docs, model).join(labels.join(teach, "doc_id", "left_anti"), "doc_id").toPandas()
    assert len(judged) > 80
    assert (judged["kept"] == (judged["quality"] == 1)).mean() > 0.95
    assert judged[["text_score", "metadata_score", "score"]].apply(lambda c: c.between(0, 1)).all().all()
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    scored = {r.doc_id for r in quality.score_quality(docs, model).where("kept").collect()}
    assert {r.doc_id for r in kept.select("doc_id").collect()} == scored


def test_views_teach_each_other():
    """A view with few labels of its own gets better by those of the other."""
    rng = np.random.default_rng(8)
    truth = rng.integers(0, 2, 3000)
    content = truth[:, None] * 3.0 + rng.normal(size=(3000, 2))
    metadata = np.eye(40)[np.where(truth == 1, 0, 20) + rng.integers(0, 20, 3000)]
    label = np.where(np.arange(3000) < 60, truth, -1)
    kept_out = np.arange(3000) % 2 == 0
    both = quality.co_train(content, metadata, label, kept_out)
    alone = quality.fit_logistic(metadata[:60][~kept_out[:60]], truth[:60][~kept_out[:60]])
    rest = slice(60, None)
    taught = ((both.metadata.odds(metadata[rest]) > 0) == truth[rest]).mean()
    assert taught > ((alone.odds(metadata[rest]) > 0) == truth[rest]).mean()
    assert ((both.scores(content, metadata)[2][rest] >= 0.5) == truth[rest]).mean() > 0.9


def test_quality_of_odd_rows(spark):
    docs = _docs(spark, 40).drop("source")
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (2, None), (3, 7), (None, 0)], "doc_id long, quality int")
    got = quality.quality_classifier(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.score == got[0].score for r in got)  # one kind of label only: the prior
    none = quality.quality_classifier(docs.limit(0), labels.limit(0))
    assert none.count() == 0
    assert quality.keep_good(docs, quality.CoTrained(None, None, 0.9)).count() == docs.count()


@pytest.fixture(scope="module")
def scanned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    long = "word " * 400 + "Released under the MIT License. " + "other " * 400
    more = [
        (10_000, None), (10_001, ""), (10_002, long), (10_003, "A license to drive.\nlicensed   under the apache LICENSE, version 2.0!"),
        (10_004, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (10_004, "plain words"), (None, "SPDX-License-Identifier: MPL-2.0"),
    ]
    every = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string")).withColumn("row", F.lit(1))
    return every, licenses.license_scan(every)


def test_license_scan_finds_what_a_search_finds(spark, scanned):
    every, found = scanned
    wanted = {
        "Apache-2.0": "apache license, version 2.0", "MIT": "under the mit license", "CC-BY-NC": "cc by-nc 4.0",
        "GPL-3.0": "gnu general public license, version 3", "MPL-2.0": "mpl-2.0",
    }
    expected = []
    for d, t in every.select("doc_id", "text").collect():
        low = re.sub(r"\s+", " ", (t or "").lower())
        expected.append((str(d), ",".join(sorted(f for f, x in wanted.items() if x in low))))
    got = sorted((str(r.doc_id), r.families) for r in found.collect())
    assert got == sorted(expected)
    assert sum(bool(f) for _, f in got) > 10


def test_license_scan_is_native(scanned):
    plan = scanned[1]._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_license_scan_of_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.license_scan(none).count() == 0
