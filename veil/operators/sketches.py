"""Quantiles from stored sketches, so that a table that grows is profiled by reading its new part only.

A sketch holds a bounded sample of one column of one part, whatever its rows. Sketches of all parts merge into one of
the same error: the ranks of all answers differ from the asked ones by at most ``rank_error`` of the rows, with
a confidence of 99 %. Twice the error is never exceeded in practice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.functions.templates import quoted

# The largest size Spark takes: about 100 kB a sketch.
SIZE = 4096


def rank_error(size: int = SIZE) -> float:
    """The part of the rows by which the rank of any answer can be off, as published for this sketch."""
    return 2.446 / size**0.9433


def append_sketches(df: DataFrame, columns: Sequence[str], path: str, size: int = SIZE) -> None:
    """Read one part of a table once and add its ``column, not_null, min, max, sketch`` to the sketches in ``path``.

    Nulls and NaN take no part. A column without values adds a row without a sketch.
    """
    cells = []
    for c in columns:
        x = F.col(quoted(c)).cast("double")
        x = F.when(~F.isnan(x), x)
        sketch = F.expr(f"kll_sketch_agg_double(CASE WHEN NOT isnan(CAST({quoted(c)} AS double)) THEN CAST({quoted(c)} AS double) END, {size})")
        n = F.count(x)
        cells.append(
            F.struct(F.lit(c).alias("column"), n.alias("not_null"), F.min(x).alias("min"), F.max(x).alias("max"), F.when(n > 0, sketch).alias("sketch"))
        )
    rows = df.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))
    rows.write.mode("append").parquet(path)


def sketched_quantiles(spark: SparkSession, path: str, probabilities: Sequence[float]) -> DataFrame:
    """``column, not_null, min, max, probability, value`` over all parts; ``min`` and ``max`` are exact, ``value`` is off by the rank error."""
    stored = spark.read.parquet(path)
    merged = stored.groupBy("column").agg(
        F.sum("not_null").alias("not_null"), F.min("min").alias("min"), F.max("max").alias("max"), F.expr("kll_merge_agg_double(sketch)").alias("sketch")
    )
    found = F.expr("not_null > 0")
    # ranks must be constants
    answers = [F.struct(F.lit(float(p)).alias("probability"), F.when(found, F.expr(f"kll_sketch_get_quantile_double(sketch, {float(p)!r}D)")).alias("value")) for p in probabilities]
    return merged.select("column", "not_null", "min", "max", F.inline(F.array(*answers)))
