"""Statistics of numeric columns: moments, quantiles, outlier bounds and the values next to them.

All columns are handled together, so one pass serves every column. Whole numbers and decimals keep
their type; only means, deviations and bounds are doubles. Exact quantiles need two scans and never one
task that holds all values; ``accuracy`` asks for the mergeable sketch instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, NumericType, StringType, StructField, StructType

from veil.functions.longform import COLUMN, VALUE, long_form, with_names
from veil.functions.templates import as_list, quoted
from veil.operators.ranks import Overview, common_type, exact_quantiles, overview

# The points and the column names of the profile report.
PROFILE_QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)
QUARTILES = (0.25, 0.75)
BOUND_RULES = ("3sigma", "1.5iqr")


def numeric_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The numeric ones among ``columns``, in the order of the table."""
    wanted = set(columns)
    return [f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, NumericType)]


def long_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The non-null values of numeric columns in their common type, with the column's place."""
    return long_form(df, columns, common_type(df, columns).simpleString()).where(F.col(VALUE).isNotNull())


def quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], accuracy: int | None = None
) -> DataFrame:
    """Quantiles as ``(column, point, value)``: the smallest value whose share of rows reaches the point."""
    if accuracy is None:
        return with_names(exact_quantiles(df, columns, points), columns)
    sketch = F.percentile_approx(VALUE, list(points), accuracy)
    found = (
        long_numbers(df, columns)
        .groupBy(COLUMN)
        .agg(F.arrays_zip(F.array(*map(F.lit, points)).alias("point"), sketch.alias(VALUE)).alias("found"))
        .select(COLUMN, F.inline("found"))
    )
    return with_names(found, columns)


def moments(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """Count, extremes, mean, median and higher moments, one row per numeric column."""
    names = numeric_columns(df, columns)
    number = F.col(VALUE).cast("double")
    found = (
        long_numbers(df, names)
        .groupBy(COLUMN)
        .agg(
            F.count(VALUE).alias("not_null"),
            F.min(VALUE).alias("min"),
            F.max(VALUE).alias("max"),
            F.array(F.min(VALUE), F.max(VALUE)).alias("min_max"),
            F.avg(number).alias("avg"),
            F.percentile_approx(VALUE, 0.5, accuracy).alias("median"),
            F.stddev_samp(number).alias("stddev"),
            F.skewness(number).alias("skewness"),
            F.kurtosis(number).alias("kurtosis"),
        )
    )
    return with_names(found, names)


def sigma_range(df: DataFrame, column: str, z: float = 3.0) -> DataFrame:
    """One row ``low, up``: mean -/+ z standard deviations; nulls when there is at most one value."""
    c = F.col(quoted(column)).cast("double")
    spread = F.stddev_samp(c) * z
    return df.agg((F.avg(c) - spread).alias("low"), (F.avg(c) + spread).alias("up"))


def iqr_range(df: DataFrame, column: str, accuracy: int | None = None) -> DataFrame:
    """One row ``low, up``: quartiles -/+ 1.5 interquartile ranges."""
    if isinstance(df.schema[column].dataType, StringType):
        raise ValueError(f"interquartile range of string column {column!r}")
    if accuracy is None:
        found = exact_quantiles(df, [column], QUARTILES)
        q1, q3 = [F.max(F.when(F.col("point") == p, F.col(VALUE).cast("double"))) for p in QUARTILES]
        quartiles = found.agg(q1.alias("q1"), q3.alias("q3"))
    else:
        pair = F.percentile_approx(F.col(quoted(column)).cast("double"), list(QUARTILES), accuracy)
        quartiles = df.agg(pair.alias("q")).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))
    fence = (F.col("q3") - F.col("q1")) * 1.5
    return quartiles.select((F.col("q1") - fence).alias("low"), (F.col("q3") + fence).alias("up"))


def outlier_range(df: DataFrame, column: str, rule: str, accuracy: int | None = None) -> DataFrame:
    if rule == "3sigma":
        return sigma_range(df, column)
    if rule == "1.5iqr":
        return iqr_range(df, column, accuracy)
    raise ValueError(f"unknown rule {rule!r}; known: {', '.join(BOUND_RULES)}")


def nearest_values(df: DataFrame, column: str, bounds: DataFrame, lower="right", upper="left") -> DataFrame:
    """The six values of a rule: each bound with the observed values on its left and right.

    ``bounds`` is a one-row table ``low, up``. Sides not asked for are null.
    """
    c = F.col(quoted(column))
    b = bounds.select(F.struct("low", "up")).scalar()
    number, none = c.cast("double"), F.lit(None).cast(df.schema[column].dataType)
    aggregates = {}
    for side, wanted in (("low", lower), ("up", upper)):
        aggregates[f"{side}_left"] = F.max(F.when(number <= b[side], c)) if _asks(wanted, "left") else none
        aggregates[side] = F.max(b[side]).cast("double") if wanted else _no_value()
        aggregates[f"{side}_right"] = F.min(F.when(number >= b[side], c)) if _asks(wanted, "right") else none
    return df.agg(*[a.alias(n) for n, a in aggregates.items()])


def numeric_profile(
    df: DataFrame,
    columns: Sequence[str],
    accuracy: int | None = None,
    lower: str | Sequence[str] | None = "right",
    upper: str | Sequence[str] | None = "left",
    z: float = 3.0,
) -> DataFrame:
    """One row per numeric column: count, extremes, percentiles, and both outlier rules.

    Values come in the common type of the columns, bounds as double. The data is read three times: for the
    overview, for the values near the percentiles, and for the neighbours of the bounds. With
    ``accuracy`` a sketch gives the percentiles, and the second reading is saved.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    names = numeric_columns(df, columns)
    if not names:
        raise ValueError("none of the columns is numeric")
    kind = common_type(df, names)
    known = overview(df, names, PROFILE_QUANTILES)
    if accuracy is None:
        found = exact_quantiles(df, names, PROFILE_QUANTILES, known)
    else:
        sketch = F.percentile_approx(VALUE, list(PROFILE_QUANTILES), accuracy)
        points = F.array(*map(F.lit, PROFILE_QUANTILES)).alias("point")
        rows = long_numbers(df, names).groupBy(COLUMN).agg(F.arrays_zip(points, sketch.alias(VALUE)).alias("found"))
        found = rows.select(COLUMN, F.inline("found"))
    # one row per column and point
    percentiles = {(r[COLUMN], r["point"]): r[VALUE] for r in found.collect()}
    lines = []
    for i, name in enumerate(names):
        own = known[name]
        q = [percentiles.get((i, p)) for p in PROFILE_QUANTILES]
        bounds = _bounds(own, q[1], q[3], z)
        for side, wanted in (("low", lower), ("up", upper)):
            bounds |= {f"{side}({rule})": None for rule in BOUND_RULES if not wanted}
        lines.append([name, own.not_null, own.least, own.most, *q, bounds])
    nearby = df.agg(*[a for i, line in enumerate(lines) for a in _neighbours(i, names[i], kind, line[-1], lower, upper)]).first()
    layout = [("min", kind), ("max", kind), *((_percent(p), kind) for p in PROFILE_QUANTILES)]
    for rule in BOUND_RULES:
        for side in ("low", "up"):
            layout += [(f"{side}({rule})_left", kind), (f"{side}({rule})", DoubleType()), (f"{side}({rule})_right", kind)]
    rows = []
    for i, (*head, bounds) in enumerate(lines):
        ends = []
        for rule in BOUND_RULES:
            for side in ("low", "up"):
                name = f"{side}({rule})"
                ends += [nearby[f"{i}{name}_left"], bounds[name], nearby[f"{i}{name}_right"]]
        rows.append((*head, *ends))
    fields = [StructField(COLUMN, StringType()), StructField("not_null", LongType())]
    return df.sparkSession.createDataFrame(rows, StructType([*fields, *[StructField(n, t) for n, t in layout]]))


def _bounds(own: Overview, q1, q3, z: float) -> dict[str, float | None]:
    """The bounds of both rules; a column of one value has no deviation."""
    sigma = None if own.deviation is None else z * own.deviation
    fence = None if q1 is None else 1.5 * (float(q3) - float(q1))
    return {
        "low(3sigma)": None if sigma is None else own.mean - sigma,
        "up(3sigma)": None if sigma is None else own.mean + sigma,
        "low(1.5iqr)": None if fence is None else float(q1) - fence,
        "up(1.5iqr)": None if fence is None else float(q3) + fence,
    }


def _neighbours(i: int, column: str, kind: DataType, bounds: dict[str, float | None], lower, upper) -> list[Column]:
    value, number, none = F.col(quoted(column)).cast(kind), F.col(quoted(column)).cast("double"), F.lit(None).cast(kind)
    out = []
    for name, bound in bounds.items():
        wanted = lower if name.startswith("low") else upper
        left = right = none
        if bound is not None:
            left = F.max(F.when(number <= F.lit(bound), value)) if _asks(wanted, "left") else none
            right = F.min(F.when(number >= F.lit(bound), value)) if _asks(wanted, "right") else none
        out += [left.alias(f"{i}{name}_left"), right.alias(f"{i}{name}_right")]
    return out


def _percent(point: float) -> str:
    return f"{round(point * 100)}%"


def _asks(wanted, side: str) -> bool:
    return any(side in w for w in as_list(wanted))


def _no_value():
    return F.lit(None).cast("double")
