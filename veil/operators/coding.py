"""Top and bottom coding: pull values beyond a bound back to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.templates import Step, quoted
from veil.operators.stats import BOUND_RULES, outlier_range


def top_bottom_coding(df: DataFrame, step: Step) -> DataFrame:
    """``top`` and ``bottom`` are each ``[threshold, replacement]``, '3sigma', '1.5iqr' or absent.

    A computed bound enters the row-local expression as a scalar subquery, so the table itself is
    neither shuffled nor joined. A bound that cannot be computed leaves values as they are.
    """
    value = F.col(quoted(step.column))
    statistics = step.stats_frame(df, "{0}")
    rules = {r for r in (step.config.get("top"), step.config.get("bottom")) if isinstance(r, str)}
    ranges = {
        r: outlier_range(statistics, step.column, r, step.config.get("accuracy")).select(F.struct("low", "up")).scalar()
        for r in sorted(rules)
    }
    top = _limit(step.config.get("top"), ranges, "up")
    bottom = _limit(step.config.get("bottom"), ranges, "low")

    coded = None
    if top is not None:
        coded = F.when(value > top[0], top[1])
    if bottom is not None:
        coded = F.when(value < bottom[0], bottom[1]) if coded is None else coded.when(value < bottom[0], bottom[1])
    return df.withColumn(step.output, value if coded is None else coded.otherwise(value))


def _limit(setting, ranges: dict[str, Column], side: str) -> tuple[Column, Column] | None:
    if setting is None:
        return None
    if isinstance(setting, str):
        if setting not in BOUND_RULES:
            raise ValueError(f"unknown rule {setting!r}; known: {', '.join(BOUND_RULES)}")
        return ranges[setting][side], ranges[setting][side]
    threshold, replacement = setting
    return F.lit(threshold), F.lit(replacement)
