"""Exact quantiles of many columns in two scans, with a small shuffle.

The first scan makes a sketch of each column, which brackets every wanted quantile between two values.
The second counts the values below, between and above the brackets, and tells apart only the values
inside them; that is all that is shuffled. The rank of a quantile then points at one of those values.
If a bracket misses its rank, the columns concerned are counted again with wider brackets, at last with
one that holds everything. Sketches work on doubles, ranks on the values as they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType, LongType

from veil.functions.longform import COLUMN, VALUE
from veil.functions.templates import quoted
from veil.operators.identity import SLICE, ordered_slices, running_offsets
from veil.plans.tables import keep

COPIES = "_copies"
# Size of the sketches, and the distance of a bracket from its point: three times their rank error.
SKETCH_SIZE = 4096
MARGIN = 0.004
# Above this many different values inside the brackets they are ranked in range partitions.
_IN_WINDOWS = 5_000_000
_PART = "_part"


def common_type(df: DataFrame, columns: Sequence[str]) -> DataType:
    """The type that holds the values of numeric columns without loss: long or decimal; double if any is a float."""
    types = [df.schema[c].dataType for c in columns]
    if any(isinstance(t, (FloatType, DoubleType)) for t in types):
        return DoubleType()
    scales = [t.scale for t in types if isinstance(t, DecimalType)]
    return DecimalType(38, max(scales)) if scales else LongType()


@dataclass(frozen=True)
class Overview:
    """What one scan tells of a column."""

    not_null: int
    least: object
    most: object
    mean: float | None
    deviation: float | None
    brackets: dict[float, tuple[float, float]]
    """Per point a lower and an upper value between which the quantile is expected."""


def overview(df: DataFrame, columns: Sequence[str], points: Sequence[float], margin: float = MARGIN) -> dict[str, Overview]:
    """Count, extremes, mean, sample deviation and quantile brackets of numeric columns, from one scan."""
    if not columns:
        return {}
    kind = common_type(df, columns)
    edges = [min(1.0, max(0.0, p + side * margin)) for p in points for side in (-1, 1)]
    aggregates = []
    for i, c in enumerate(columns):
        value, number = F.col(quoted(c)).cast(kind), F.col(quoted(c)).cast("double")
        aggregates += [
            F.count(value).alias(f"n{i}"), F.min(value).alias(f"least{i}"), F.max(value).alias(f"most{i}"),
            F.avg(number).alias(f"mean{i}"), F.stddev_samp(number).alias(f"sd{i}"),
            F.expr(f"kll_sketch_agg_double(CAST({quoted(c)} AS DOUBLE), {SKETCH_SIZE})").alias(f"sketch{i}"),
        ]
    # one row: a sketch of fixed size per column
    row = df.agg(*aggregates)
    asked = [f"CAST({e!r} AS DOUBLE)" for e in edges] or ["CAST(0.5 AS DOUBLE)"]
    cuts = [
        F.when(F.col(f"n{i}") > 0, F.expr(f"kll_sketch_get_quantile_double(sketch{i}, array({', '.join(asked)}))")).alias(f"cuts{i}")
        for i in range(len(columns))
    ]
    found = row.select(*[c for c in row.columns if not c.startswith("sketch")], *cuts).first()
    out = {}
    for i, c in enumerate(columns):
        values = found[f"cuts{i}"] or []
        pairs = {p: (values[2 * k], values[2 * k + 1]) for k, p in enumerate(points)} if values else {}
        # the ends of the range belong to the outermost points
        pairs = {
            p: (-math.inf if p - margin <= 0 else low, math.inf if p + margin >= 1 else high) for p, (low, high) in pairs.items()
        }
        out[c] = Overview(found[f"n{i}"], found[f"least{i}"], found[f"most{i}"], found[f"mean{i}"], found[f"sd{i}"], pairs)
    return out


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], known: Mapping[str, Overview] | None = None
) -> DataFrame:
    """``column, point, value`` with the place of the column: the smallest value whose share of rows reaches the point."""
    kind = common_type(df, columns)
    known = overview(df, columns, points) if known is None else known
    wanted = [i for i, c in enumerate(columns) if known[c].not_null]
    brackets = {i: _merged(known[columns[i]].brackets.values()) for i in wanted}
    parts, widen = [], MARGIN
    while wanted:
        counted = keep(_counted(df, columns, kind, {i: brackets[i] for i in wanted}), "bracketed").df
        sizes = {
            (r[COLUMN], r[_PART]): r["n"]
            # a few parts per column
            for r in counted.groupBy(COLUMN, _PART).agg(F.sum(COPIES).alias("n")).collect()
        }
        targets, missed = [], []
        for i in wanted:
            own = [_target(i, float(p), known[columns[i]].not_null, sizes, len(brackets[i])) for p in points]
            if None in own:
                missed.append(i)
            else:
                targets += own
        if targets:
            parts.append(_ranked(counted, targets, kind))
        widen *= 10
        if missed:
            wider = overview(df, [columns[i] for i in missed], points, widen)
            everything = [(-math.inf, math.inf)]
            brackets = {i: everything if widen >= 0.4 else _merged(wider[columns[i]].brackets.values()) for i in missed}
        wanted = missed
    if not parts:
        schema = f"{COLUMN} int, point double, {VALUE} {kind.simpleString()}"
        return df.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _merged(pairs) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(pairs):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _double(x: float) -> Column:
    return F.lit(x).cast("double")


def _counted(df: DataFrame, columns: Sequence[str], kind: DataType, brackets: Mapping[int, list]) -> DataFrame:
    """``column, part, value, copies``: odd parts are brackets and keep their values, even ones only a count."""
    cells = []
    for i, own in brackets.items():
        number = F.col(quoted(columns[i])).cast("double")
        part = F.when(number.isNull(), F.lit(None).cast("int"))
        for k, (low, high) in enumerate(own):
            # not-a-number is above infinity, so an open end takes it in
            end = math.nan if high == math.inf else high
            part = part.when(number < _double(low), 2 * k).when(number <= _double(end), 2 * k + 1)
        part = part.otherwise(2 * len(own))
        value = F.when(part % 2 == 1, F.col(quoted(columns[i])).cast(kind))
        cells.append(F.struct(F.lit(i).alias(COLUMN), part.alias(_PART), value.alias(VALUE)))
    long = df.select(F.inline(F.array(*cells))).where(F.col(_PART).isNotNull())
    return long.groupBy(COLUMN, _PART, VALUE).agg(F.count(F.lit(1)).alias(COPIES))


def _target(i: int, point: float, total: int, sizes: Mapping, n: int) -> tuple | None:
    """``(column, part, point, rank within the part)`` of a quantile, or None where a count stands in its place."""
    rank = max(1, math.ceil(point * total))
    for part in range(2 * n + 1):
        size = sizes.get((i, part), 0)
        if rank <= size:
            return (i, part, point, rank) if part % 2 else None
        rank -= size
    return None


def _ranked(counted: DataFrame, targets: list[tuple], kind: DataType) -> DataFrame:
    inside = counted.where(F.col(_PART) % 2 == 1)
    found = counted.sparkSession.createDataFrame(targets, f"{COLUMN} int, {_PART} int, point double, _rank long")
    # one row per column and point
    found = F.broadcast(found)
    if inside.count() <= _IN_WINDOWS:
        upto = F.sum(COPIES).over(W.partitionBy(COLUMN, _PART).orderBy(VALUE).rowsBetween(W.unboundedPreceding, 0))
        ranked = inside.withColumn("_upto", upto)
    else:
        slices = ordered_slices(inside, COLUMN, _PART, VALUE, label="bracket-slices").df
        sizes = slices.groupBy(COLUMN, _PART, SLICE).agg(F.sum(COPIES).alias("_size"))
        # one row per column, part and slice
        before = F.broadcast(running_offsets(sizes, "_size", COLUMN, _PART).drop("_size"))
        own = W.partitionBy(COLUMN, _PART, SLICE).orderBy(VALUE).rowsBetween(W.unboundedPreceding, 0)
        ranked = slices.withColumn("_own", F.sum(COPIES).over(own)).join(before, [COLUMN, _PART, SLICE])
        ranked = ranked.withColumn("_upto", F.col("_own") + F.col("_before"))
    hit = F.col("_rank").between(F.col("_upto") - F.col(COPIES) + 1, F.col("_upto"))
    return ranked.join(found, [COLUMN, _PART]).where(hit).select(COLUMN, "point", VALUE)
