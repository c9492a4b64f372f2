import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veil.operators import stats

POINTS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def exact(data, p):
    data = sorted(data)
    return data[max(math.ceil(p * len(data)), 1) - 1]


def found(df):
    return {(r["column"], r["point"]): r["value"] for r in df.collect()}


def test_quantiles_with_a_hot_value(spark):
    df = spark.range(4000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.hash("id") % 1000).cast("int").alias("a"),
        F.when(F.col("id") > 20, F.rand(3)).alias("b"),
    )
    got = found(stats.quantiles(df, ["a", "b"], POINTS))
    for c in ("a", "b"):
        data = [r[0] for r in df.select(c).where(f"{c} IS NOT NULL").collect()]
        assert [got[(c, p)] for p in POINTS] == [exact(data, p) for p in POINTS]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=30))
def test_quantiles_of_small_lists(spark, data):
    df = spark.createDataFrame([(v,) for v in data], "a int")
    present = [v for v in data if v is not None]
    got = found(stats.quantiles(df, ["a"], [0.25, 0.5]))
    assert got == ({("a", p): exact(present, p) for p in (0.25, 0.5)} if present else {})


def test_sketch_quantiles(spark):
    df = spark.range(1, 101).select(F.col("id").alias("a"))
    assert found(stats.quantiles(df, ["a"], [0.25, 0.5], accuracy=10000)) == {("a", 0.25): 25.0, ("a", 0.5): 50.0}


def test_ranges(spark):
    df = spark.range(1, 101).select(F.col("id").alias("a"), F.lit("x").alias("s"))
    row = stats.iqr_range(df, "a").first()
    assert (row["low"], row["up"]) == (-50.0, 150.0)
    assert tuple(stats.iqr_range(df, "a", 10000).first()) == (-50.0, 150.0)
    row = stats.sigma_range(df, "a", 2).first()
    sd = np.std(range(1, 101), ddof=1)
    assert row["low"] == pytest.approx(50.5 - 2 * sd) and row["up"] == pytest.approx(50.5 + 2 * sd)
    one = stats.sigma_range(df.limit(1), "a").first()
    assert one["low"] is None and one["up"] is None
    with pytest.raises(ValueError, match="string column"):
        stats.iqr_range(df, "s")


def test_nearest_values(spark):
    df = spark.createDataFrame([(v,) for v in [1, 5, 9, 20]], "a int")
    bounds = spark.createDataFrame([(4.0, 10.0)], "low double, up double")
    assert tuple(stats.nearest_values(df, "a", bounds, "left,right", ["left", "right"]).first()) == (1, 4, 5, 9, 10, 20)
    assert tuple(stats.nearest_values(df, "a", bounds).first()) == (None, 4, 5, 9, 10, None)
    assert tuple(stats.nearest_values(df, "a", bounds, None, "left").first()) == (None, None, None, 9, 10, None)


@pytest.mark.parametrize("accuracy", [None, 100000])
def test_profile(spark, accuracy):
    df = spark.range(1, 1001).select(
        F.col("id").alias("a"),
        F.when(F.col("id") == 1000, 1e6).otherwise(F.col("id") / 2).alias("b"),
        F.lit(None).cast("double").alias("empty"),
        F.lit("x").alias("text"),
        F.col("id").cast("decimal(10,2)").alias("dec"),
        F.when(F.col("id") == 7, 7).alias("one"),
    )
    rows = {r["column"]: r for r in stats.numeric_profile(df, df.columns, accuracy).collect()}
    assert list(rows) == ["a", "b", "empty", "dec", "one"]
    a = rows["a"]
    assert (a["not_null"], a["min"], a["max"], a["1%"], a["50%"], a["99%"]) == (1000, 1, 1000, 10, 500, 990)
    sd = np.std(range(1, 1001), ddof=1)
    assert a["low(3sigma)"] == pytest.approx(500.5 - 3 * sd) and a["low(3sigma)_right"] == 1
    assert a["low(3sigma)_left"] is None and a["up(3sigma)_left"] == 1000 and a["up(3sigma)_right"] is None
    assert rows["b"]["up(1.5iqr)_left"] == 499.5 and rows["b"]["up(3sigma)_left"] == 499.5
    assert rows["dec"]["75%"] == 750.0
    empty = rows["empty"].asDict()
    assert empty.pop("not_null") == 0 and empty.pop("column") == "empty" and set(empty.values()) == {None}
    one = rows["one"]
    assert one["not_null"] == 1 and one["low(3sigma)"] is None and one["low(1.5iqr)"] == 7 and one["25%"] == 7
    with pytest.raises(ValueError, match="no such column"):
        stats.numeric_profile(df, ["zzz"])
    with pytest.raises(ValueError, match="numeric"):
        stats.numeric_profile(df, ["text"])


def test_moments(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 10.0, None]], "a double")
    row = stats.moments(df, ["a"]).first()
    assert (row["not_null"], row["min_max"], row["avg"], row["median"]) == (4, [1.0, 10.0], 4.0, 2.0)
    x = np.array([1.0, 2, 3, 10]) - 4
    assert row["stddev"] == pytest.approx(np.sqrt((x**2).sum() / 3))
    assert row["skewness"] == pytest.approx((x**3).mean() / (x**2).mean() ** 1.5)
    assert row["kurtosis"] == pytest.approx((x**4).mean() / (x**2).mean() ** 2 - 3)


def test_quantiles_keep_the_type_of_the_values(spark):
    base = 2**53
    df = spark.range(1, 2000).select((F.col("id") * 2 + base + 1).alias("a"), (F.col("id") / F.lit(8)).cast("decimal(30,3)").alias("d"))
    got = found(stats.quantiles(df.select("a"), ["a"], POINTS))
    assert [got[("a", p)] for p in POINTS] == [exact([2 * i + base + 1 for i in range(1, 2000)], p) for p in POINTS]
    values = sorted(r["d"] for r in df.select("d").collect())
    got = found(stats.quantiles(df.select("d"), ["d"], POINTS))
    assert [got[("d", p)] for p in POINTS] == [exact(values, p) for p in POINTS]
    of_a = stats.moments(df, ["a", "d"]).where("column = 'a'").first()
    assert of_a["min"] == base + 3 and of_a["max"] == 2 * 1999 + base + 1


@pytest.mark.parametrize("margin", [0.0, -0.2])
def test_brackets_that_miss_are_widened(spark, monkeypatch, margin):
    from veil.operators import ranks

    monkeypatch.setattr(ranks, "overview", lambda df, c, p, m=margin, f=ranks.overview: f(df, c, p, m))
    monkeypatch.setattr(ranks, "SKETCH_SIZE", 16)
    df = spark.range(5000).select((F.hash("id") % 3000).alias("a"), F.rand(1).alias("b"))
    got = found(stats.quantiles(df, ["a", "b"], POINTS))
    for c in ("a", "b"):
        data = [r[0] for r in df.select(c).collect()]
        assert [got[(c, p)] for p in POINTS] == [exact(data, p) for p in POINTS]


def test_many_values_in_brackets_are_ranked_in_slices(spark, monkeypatch):
    from veil.operators import ranks

    monkeypatch.setattr(ranks, "_IN_WINDOWS", 10)
    df = spark.range(3000).select((F.hash("id") % 3000).alias("a"))
    data = [r[0] for r in df.collect()]
    got = found(stats.quantiles(df, ["a"], POINTS))
    assert [got[("a", p)] for p in POINTS] == [exact(data, p) for p in POINTS]


def test_not_a_number_is_the_largest(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, float("nan"), float("nan"), float("inf")]], "a double")
    got = found(stats.quantiles(df, ["a"], [0.5, 1.0]))
    assert got[("a", 0.5)] == 3.0 and math.isnan(got[("a", 1.0)])


def test_quantiles_shuffle_only_what_brackets_hold(spark):
    """Two scans, and few values in the exchange."""
    from veil.operators import ranks

    df = spark.range(200_000).select(F.rand(5).alias("a"))
    known = ranks.overview(df, ["a"], [0.25, 0.5])
    counted = ranks._counted(df, ["a"], ranks.common_type(df, ["a"]), {0: ranks._merged(known["a"].brackets.values())})
    assert counted.count() < 0.03 * 200_000
    assert counted.agg(F.sum(ranks.COPIES)).first()[0] == 200_000
