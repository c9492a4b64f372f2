"""The licence classifier learns from every different window of the corpus, however few lend the words around notices."""

from veil.llm import licenses


def test_every_window_trains_or_calibrates(spark, monkeypatch):
    rows = [f"paragraph {i % 600} of plain words\n\nthe same everywhere" for i in range(700)]
    rows += [" ".join(f"w{i}" for i in range(100)), "Released under the MIT License.", None, "", "?!"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(3)
    seen, real = {}, licenses.stored

    def spy(df, label, *more):
        seen[label] = real(df, label, *more)
        return seen[label]

    monkeypatch.setattr(licenses, "stored", spy)
    model = licenses.fit(docs, 20)
    notices = licenses.VARIANTS * (sum(map(len, licenses.TEMPLATES.values())) + len(licenses._NEAR_MISSES))
    examples = seen["license-examples"]
    # 600 paragraphs, the one they share, three windows of the long one; none of the notice itself
    assert examples.count() == notices + 604
    assert 604 / 6 < examples.where("held_out").count() < 604 / 3
    assert {r.features.values.tolist() == [1.0] * len(r.features.indices) for r in examples.limit(50).collect()} == {True}
    amid = seen["notices-amid-windows"].collect()
    # beyond the bound, 80 windows here, notices stand amid windows, so that these do not speak against them
    assert amid and all(r.foreign and not r.held_out and r.label >= 0 for r in amid)
    assert len(model.stages.stages) == 2 and 0.5 <= model.level <= 0.95
