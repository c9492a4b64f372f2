"""What the classifiers are trained on: bounded draws that look at every row and take repeated ones once."""

import numpy as np
from pyspark.sql import functions as F

from veil.llm import language, licenses, quality

SF = "/root/testdata/sf0.001"


def test_windows_are_drawn_once_and_within_the_bound(spark):
    docs = spark.createDataFrame([(i, f"paragraph {i % 300} of words\n\nthe same everywhere") for i in range(900)], "doc_id long, text string")
    every = {tuple(r.words) for r in licenses._drawn(docs, 1000).collect()}
    assert every == {("paragraph", str(i), "of", "words") for i in range(300)} | {("the", "same", "everywhere")}
    few = [tuple(r.words) for r in licenses._drawn(docs, 20).collect()]
    assert 10 <= len(few) <= 20 * licenses.PER_FOREIGN and len(set(few)) == len(few) and set(few) <= every
    assert sorted(few) == sorted(tuple(r.words) for r in licenses._drawn(docs.repartition(5), 20).collect())


def test_rows_whose_place_changes_keep_their_findings(spark):
    """A table out of a shuffle has its rows in other places at every reading."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 40")
    more = [(1000 + i, "Released under the MIT License." if i % 2 else "plain words here") for i in range(40)]
    every = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    found = licenses.license_scan(every.repartition(7, F.rand())).where("doc_id >= 1000").collect()
    assert sorted((r.doc_id, r.families) for r in found) == [(d, "MIT" if d % 2 else "") for d, _ in more]


def test_quality_sample_has_one_row_an_id(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    hot = labels.where("quality = 1").agg(F.min("doc_id")).first()[0]
    copies = docs.where(F.col("doc_id") == hot).withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("_i")
    once, often = quality.fit(docs, labels), quality.fit(docs.unionByName(copies).repartition(5), labels)
    assert np.allclose(once.content.weights, often.content.weights) and np.allclose(once.metadata.weights, often.metadata.weights)


def test_draws_at_scale_are_those_in_memory(spark):
    """Where no view is sure of more than are drawn, the exchange over a table finds what the plain form finds."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    none = F.lit(None).cast("int")
    rows = quality._described(docs, F.col("doc_id"), none).mapInArrow(quality._describe, quality._DESCRIBED)
    pool = rows.select("content", "metadata").distinct()
    packed = pool.toPandas()
    model = quality.fit(docs, labels)
    models = [model.content, model.metadata]
    key = lambda found: {(s.view, s.value, c.tobytes(), m.tobytes()) for s in found for c, m in zip(s.content, s.metadata)}
    unpacked = quality._unpacked(list(packed["content"]), list(packed["metadata"]))
    sure = quality.sure_of(models, *unpacked)
    assert max(x.sum() for x in sure.values()) <= quality.PER_ROUND
    got = quality.draw_at_scale(pool)(models, 1)
    assert sum(len(s.content) for s in got) == sum(min(quality.PER_ROUND, int(x.sum())) for x in sure.values()) > 0
    assert key(got) == key(quality.draw_from(*unpacked)(models, 1))


def test_quality_takes_every_document_into_the_exchange(spark, monkeypatch):
    seen = []
    real = quality.draw_at_scale
    monkeypatch.setattr(quality, "draw_at_scale", lambda pool: seen.append(pool.count()) or real(pool))
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    quality.fit(docs, labels)
    marked = labels.where("quality IN (0, 1)").select("doc_id").distinct().count()
    copies = docs.count() - docs.dropDuplicates(["text", *quality.METADATA]).count()
    assert docs.count() - marked - copies <= seen[0] <= docs.count() - marked


def test_language_sample_has_one_window_a_place(spark):
    rows = [(1, "barka dorum " * 40, "xx")] * 300 + [(5, "schwert zwirn " * 40, "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once, often = language.fit(docs.distinct()), language.fit(docs.repartition(4))
    assert np.array_equal(once.bias, often.bias) and once.langs == often.langs
