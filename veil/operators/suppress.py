"""Suppression of rare or matching values, and the handling of repeated keys and rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.templates import Step
from veil.operators.lookup import (
    COUNT,
    attach_group_count,
    count_in_window,
    group_counts,
    hot_groups,
    lookup,
)
from veil.plans.tables import keep, measure

_VALUE, _SEEN = "_k0", "_seen"


def groupby_count(df: DataFrame, step: Step) -> DataFrame:
    """Attach the size of each row's group over the columns in ``by``."""
    by = step.config["by"] if isinstance(step.config["by"], (list, tuple)) else [step.config["by"]]
    return attach_group_count(
        df,
        [step.expr(b) for b in by],
        step.output,
        null_keys=step.config.get("null_keys", "null"),
        source=step.stats_frame(df, *by),
        same_rows=step.same_rows,
    )


def local_delete(df: DataFrame, step: Step) -> DataFrame:
    """Null a value that is rarer than ``under`` or matches ``regexp``; both may be given."""
    under, pattern = step.config.get("under"), step.config.get("regexp")
    if under is None and pattern is None:
        raise ValueError("local_delete needs 'under' or 'regexp'")
    template = step.config.get("origin", "{0}")
    origin = step.expr(template)
    if under is not None:
        source = step.stats_frame(df, template)
        df = suppress_rare(df, origin, under, step.output, source=source, same_rows=step.same_rows)
    else:
        df = df.withColumn(step.output, origin)
    if pattern is not None:
        df = df.withColumn(step.output, F.when(~_matches(origin, pattern), F.col(step.output)))
    return df


def suppress_rare(
    df: DataFrame,
    origin: Column,
    under: int,
    out: str,
    *,
    source: DataFrame | None = None,
    same_rows: bool = True,
) -> DataFrame:
    """``out`` is the value, or null where fewer than ``under`` rows hold it.

    Values are counted in ``source`` (default ``df``). Only one side of the threshold has to be
    looked up: when the rare or the frequent values are few enough to broadcast, no row is shuffled.
    """
    counts = keep(group_counts(df if source is None else source, [origin]), "value-counts")
    df = df.withColumn(out, origin)
    if counts.small:
        return _null_where(lookup(df, counts, [out], [_VALUE], {_SEEN: COUNT}), out, F.col(_SEEN) < under)
    known = counts.df.where(F.col(_VALUE).isNotNull())
    for side, present_is_rare in ((F.col(COUNT) < under, True), (F.col(COUNT) >= under, False)):
        sized = measure(known.where(side))
        if sized.small:
            joined = lookup(df, sized, [out], [_VALUE], {_SEEN: COUNT})
            return _null_where(joined, out, F.col(_SEEN).isNotNull() == present_is_rare)
    if same_rows:
        counted = count_in_window(df, [out], _SEEN, hot_groups(counts.df))
    else:
        counted = lookup(df, counts, [out], [_VALUE], {_SEEN: COUNT})
    return _null_where(counted, out, F.col(_SEEN) < under)


def suppress_matching(df: DataFrame, origin: Column, pattern: str, out: str) -> DataFrame:
    """``out`` is the value, or null where the pattern is found in it."""
    return df.withColumn(out, F.when(~_matches(origin, pattern), origin))


def dup_histogram(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys occur how often: ``dup_count, count, row_count``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .groupBy("dup_count")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("row_count", F.col("dup_count") * F.col("count"))
        .orderBy("dup_count")
    )


def keep_singletons(df: DataFrame, keys: Sequence[str], null_keys: str = "drop") -> DataFrame:
    """Keep the rows whose key occurs exactly once; all copies of a repeated key go.

    Where the repeated keys, or the single ones, are few enough to broadcast, no row is shuffled.
    Otherwise the groups that would fill a task are dropped first, and one shuffle counts the rest.
    """
    if null_keys not in ("drop", "group"):
        raise ValueError(f"null_keys must be 'drop' or 'group', not {null_keys!r}")
    if null_keys == "drop":
        df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counts = keep(group_counts(df, keys), "key-counts").df
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    for condition, how in (("_traffic > 1", "left_anti"), ("_traffic = 1", "left_semi")):
        side = measure(counts.where(condition).drop(COUNT))
        if side.small:
            return df.join(F.broadcast(side.df), same, how)
    # at most one group per shuffle partition
    hot = hot_groups(counts).where(F.col(COUNT) > 1).drop(COUNT)
    rest = df.join(F.broadcast(hot), same, "left_anti")
    return count_in_window(rest, keys, COUNT, None).where(F.col(COUNT) == 1).drop(COUNT)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def duplicate_row_counts(df: DataFrame) -> DataFrame:
    """Row count before and after dropping full-row copies, as one row from one aggregation."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("before"), F.count(F.lit(1)).alias("after"))
    )


def _matches(origin: Column, pattern: str) -> Column:
    # a null value matches nothing and stays null either way
    return F.coalesce(origin.cast("string").rlike(pattern), F.lit(False))


def _null_where(df: DataFrame, out: str, condition: Column) -> DataFrame:
    value = F.when(~F.coalesce(condition, F.lit(False)), F.col(out))
    return df.withColumn(out, value).drop(_SEEN)
