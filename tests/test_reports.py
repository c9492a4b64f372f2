import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from veil.plans import reports


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(100).select(
        F.col("id").alias("_rn"),
        F.when(F.col("id") < 60, "a").when(F.col("id") < 61, None).otherwise(F.concat(F.lit("v"), "id")).alias("c"),
        (F.col("id") % 3).cast("int").alias("n"),
    )


def test_frequencies(table):
    counts = reports.frequencies(table)
    assert {r["column"] for r in counts.collect()} == {"c", "n"}
    assert rows(counts.where("column = 'n'"), "value") == [("n", "0", 34), ("n", "1", 33), ("n", "2", 33)]
    assert counts.where("column = 'c' AND value IS NULL").first()["count"] == 1
    assert {r["column"] for r in reports.frequencies(table, ["c", "n"], ["n", "unknown"]).collect()} == {"c"}
    with pytest.raises(ValueError, match="no such column"):
        reports.frequencies(table, ["zzz"])


def test_frequency_keeps_type_and_order(table):
    assert [tuple(r) for r in reports.frequency(table, "n").collect()] == [(0, 34), (1, 33), (2, 33)]


def test_ratio_and_seq(table):
    counts = reports.with_seq(reports.with_ratio(reports.frequencies(table)))
    assert rows(counts.where("column = 'n'").select("seq", "value", "ratio"), "seq") == [
        (1, "1", 0.33), (2, "2", 0.33), (3, "0", 0.34),
    ]
    by_value = reports.with_seq(reports.frequencies(table), sort_count=False)
    assert rows(by_value.where("column = 'n'").select("seq", "value"), "seq") == [(1, "0"), (2, "1"), (3, "2")]
    of_c = [r["seq"] for r in counts.where("column = 'c'").orderBy("seq").collect()]
    assert of_c == list(range(1, 42))


def test_seq_over_many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(2000).select((F.col("id") % 900).alias("a"), (F.col("id") % 7).alias("b"), F.col("id").alias("u"))
    counts = reports.with_seq(reports.frequencies(df))
    got = counts.groupBy("column").agg(F.min("seq"), F.max("seq"), F.count_distinct("seq"))
    assert rows(got, "column") == [("a", 1, 900, 900), ("b", 1, 7, 7), ("u", 1, 2000, 2000)]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(
    "options, expected", [({}, 41), ({"shorten": True}, 21), ({"max_rows": 30}, 21), ({"max_rows": None}, 41)]
)
def test_listing_length(table, options, expected):
    lines = reports.listing(reports.frequencies(table), **options)
    found = rows(lines.where("column = 'c'"), "position")
    assert [r[1] for r in found] == list(range(1, expected + 1))
    assert found[-1][2:5] == (41, "a", 60)
    if expected == 21:
        assert found[10][2:] == (None, "...", None, None)
        assert [r[2] for r in found[:10]] == list(range(1, 11)) and [r[2] for r in found[11:]] == list(range(32, 42))
    assert lines.where("column = 'n'").count() == 3


def test_listing_ranks_are_cut_before_the_shuffle(table):
    plan = plan_of(reports.listing(reports.frequencies(table), shorten=True), "simple")
    # head and tail, each limited per task and again after the shuffle
    assert plan.count("WindowGroupLimit") == 4 and plan.count("Partial") == 2


def test_one_scan_serves_all_columns(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(50).select("id", (F.col("id") % 3).alias("a"), F.lit(1).alias("unused")).write.parquet(path)
    plan = plan_of(reports.frequencies(spark.read.parquet(path), ["id", "a"]))
    assert plan.count("Scan parquet") == 2 and "ReadSchema: struct<id:bigint,a:bigint>" in plan


def test_compare_matches_null_with_null(spark):
    before = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    after = spark.createDataFrame([("b",), (None,), (None,)], "c string")
    got = reports.compare_frequencies(before, after)
    assert rows(got.select("value", "count_before", "count_after"), "value") == [(None, 1, 2), ("a", 2, None), ("b", None, 1)]


def test_distribution_report_with_column_info(table):
    after = table.withColumn("c", F.lit("same")).withColumn("extra", F.lit(1))
    info = [{"no": 2, "name": " n "}, {"no": 1, "name": "c", "desc": "text"}, {"no": 3, "name": "extra"}]
    report = reports.distribution_report(table.drop("_rn"), after, shorten=True, column_info=info)
    assert report.columns[:4] == ["no", "column", "desc", "position"]
    got = rows(report.where("position = 1").select("no", "column", "value_before", "value_after"), "no")
    assert [g[:2] for g in got] == [(1, "c"), (2, "n"), (3, "extra")] and got[0][3] == "same" and got[2][2] is None
    alone = reports.distribution_report(table)
    assert alone.where("column = 'n'").count() == 3


def test_sample(spark, table):
    after = table.where("_rn <> 1").select("_rn", F.upper("c").alias("c"), F.lit("k").alias("_jk"))
    lines = reports.sample_compare(table, after, [{"filter": "n = 1", "count": 2}, {"count": 2}], "_rn < 50")
    wide = {r["name"]: r for r in reports.sample_wide(lines, 4).collect()}
    assert set(wide) == {"_rn", "c", "n"}
    assert [wide["_rn"][f"_c{i}_before"] for i in range(4)] == ["0", "1", "1", "4"]
    assert [wide["c"][f"_c{i}_after"] for i in range(4)] == ["A", None, None, "A"]
    assert wide["_rn"]["_c1_after"] == "1"
    assert reports.sample_compare(table).where("name = 'c'").count() == 5


def test_dataset_counts(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(1000).withColumn("_rn", F.col("id")).repartition(3).write.parquet(path)
    row = reports.dataset_counts({"t": spark.read.parquet(path)}).first()
    size = sum(f.stat().st_size for f in (tmp_path / "t.parquet").glob("part-*.parquet"))
    assert tuple(row) == ("t", size, 1, 1000)
    assert tuple(reports.dataset_counts({"x": spark.range(4)}, with_size=False).first()) == ("x", 1, 4)


def test_survey_needs_marks(table):
    found = reports.survey(table, [{"name": "c", "freq": "x"}, {"name": "n", "freq": "X", "summary": "O"}])
    assert list(found) == ["profile"] and found["profile"].first()["max"] == 2
