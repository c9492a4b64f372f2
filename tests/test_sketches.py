import pytest
from pyspark.sql import functions as F

from veil.operators import sketches


@pytest.mark.parametrize("size", [100, 800])
def test_error_stays_below_its_bound(spark, tmp_path, size):
    """A sample far smaller than the rows, in parts of very different sizes and values."""
    path = str(tmp_path / "s")
    bounds = [(0, 200), (200, 60_000), (60_000, 61_000)]
    for a, b in bounds:
        sketches.append_sketches(spark.range(a, b).select("id", (F.col("id") * 2).alias("odd name")), ["id", "odd name"], path, size)
    asked = [i / 50 for i in range(1, 50)]
    for r in sketches.sketched_quantiles(spark, path, asked).collect():
        scale = 1 if r["column"] == "id" else 2
        assert (r.not_null, r.min, r.max) == (61_000, 0, 60_999 * scale)
        assert abs(r.value / scale / 61_000 - r.probability) <= 2 * sketches.rank_error(size) < 0.07


def test_an_appended_part_reads_only_itself(spark, tmp_path):
    path = str(tmp_path / "s")
    sketches.append_sketches(spark.range(1000), ["id"], path)
    before = {p.name for p in (tmp_path / "s").glob("*.parquet")}
    sketches.append_sketches(spark.range(1000, 1010), ["id"], path)
    assert before < {p.name for p in (tmp_path / "s").glob("*.parquet")}
    got = sketches.sketched_quantiles(spark, path, [1.0]).first()
    assert (got.not_null, got.max, got.value) == (1010, 1009, 1009)


def test_nulls_nan_and_empty_parts(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([(None, None), (float("nan"), None), (3.0, None), (5.0, None)], "x double, y int")
    for part in (rows, rows.limit(0)):
        sketches.append_sketches(part, ["x", "y"], path)
    got = {r["column"]: (r.not_null, r.min, r.max, r.value) for r in sketches.sketched_quantiles(spark, path, [0.5]).collect()}
    assert got == {"x": (2, 3.0, 5.0, 3.0), "y": (0, None, None, None)}
