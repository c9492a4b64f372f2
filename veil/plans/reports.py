"""Reports on tables: frequencies, before/after comparison, samples, counts, column survey."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veil.functions.longform import long_form, with_names
from veil.functions.templates import as_list, quoted
from veil.operators.identity import POSITION, SLICE, ordered_slices, running_offsets
from veil.operators.rewrite import keep_where
from veil.operators.stats import numeric_profile
from veil.plans.tables import BROADCAST_BYTES, keep

IDS = ("_rn", "_jk")
SHORT_ROWS = 21
SHORT_ENDS = 10
DOTS = "..."


def report_columns(
    df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None, ids=IDS
) -> list[str]:
    """The columns a report covers, in order; a name that does not exist is an error."""
    names = list(include or df.columns)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    return [c for c in names if c not in {*as_list(exclude), *ids}]


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column with their counts, in value order."""
    value = F.col(quoted(column)).alias("value")
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("count")).orderBy("value")


def frequencies(df: DataFrame, include=None, exclude=None, ids=IDS) -> DataFrame:
    """``column, value, count`` of all columns from one pass, values as text.

    Counts are formed per task before the shuffle, so a value that fills a column costs nothing.
    """
    names = report_columns(df, include, exclude, ids)
    counts = long_form(df, names, "string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return with_names(counts, names)


def with_ratio(counts: DataFrame) -> DataFrame:
    """Add each value's share of its column."""
    # one row per column
    totals = F.broadcast(counts.groupBy("column").agg(F.sum("count").alias("_total")))
    return counts.join(totals, "column").withColumn("ratio", F.col("count") / F.col("_total")).drop("_total")


def with_seq(counts: DataFrame, sort_count: bool = True) -> DataFrame:
    """Number the values of each column 1..N in ascending (count, value) or (value, count) order.

    A column may have as many values as the table has rows, so all columns are sorted together
    into range partitions, and a value's number follows from its place in its partition and the
    column's rows in earlier ones.
    """
    slices = ordered_slices(counts, "column", *_listing_order(sort_count), label="frequencies").df
    sizes = slices.groupBy("column", SLICE).agg(
        F.count(F.lit(1)).alias("_size"), F.min(POSITION).alias("_first")
    )
    # one row per column and range partition
    offsets = F.broadcast(running_offsets(sizes, "_size", "column").drop("_size"))
    seq = F.col("_before") + F.col(POSITION) - F.col("_first") + 1
    return slices.join(offsets, ["column", SLICE]).select(*counts.columns, seq.alias("seq"))


def listing(
    counts: DataFrame, max_rows: int | None = None, shorten: bool = False, sort_count: bool = True
) -> DataFrame:
    """The printed form of frequencies: ``column, position, seq, value, count, ratio``.

    Everything is listed, unless ``max_rows`` or ``shorten`` (21 rows) is given: then columns with more
    values keep the first and last ten with a ``...`` row between.
    """
    order = _listing_order(sort_count)
    layout = ["column", "position", "seq", "value", "count", "ratio"]
    if max_rows is None and not shorten:
        full = with_seq(with_ratio(counts), sort_count)
        return full.withColumn("position", F.col("seq")).select(*layout)
    limit = min(SHORT_ROWS if shorten else max_rows, max_rows or SHORT_ROWS)
    counts = keep(counts, "frequencies").df
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("_n"), F.sum("count").alias("_total"))
    sized = counts.join(F.broadcast(sizes), "column").withColumn("ratio", F.col("count") / F.col("_total"))
    long = F.col("_n") > limit

    ascending = W.partitionBy("column").orderBy(*order)
    descending = W.partitionBy("column").orderBy(*[c.desc() for c in order])
    rank = F.row_number().over(ascending).cast("long")
    # windows see at most `limit` rows of a short column, and of a long one the ranks kept per task
    short = sized.where(~long).withColumn("seq", rank).withColumn("position", F.col("seq"))
    head = sized.where(long).withColumn("seq", rank).where(F.col("seq") <= SHORT_ENDS)
    head = head.withColumn("position", F.col("seq"))
    tail = (
        sized.where(long)
        .withColumn("_back", F.row_number().over(descending).cast("long"))
        .where(F.col("_back") <= SHORT_ENDS)
        .withColumn("seq", F.col("_n") - F.col("_back") + 1)
        .withColumn("position", 2 * SHORT_ENDS + 2 - F.col("_back"))
    )
    dots = sizes.where(long).select(
        "column",
        F.lit(SHORT_ENDS + 1).cast("long").alias("position"),
        F.lit(None).cast("long").alias("seq"),
        F.lit(DOTS).alias("value"),
        F.lit(None).cast("long").alias("count"),
        F.lit(None).cast("double").alias("ratio"),
    )
    return reduce(DataFrame.unionByName, [part.select(*layout) for part in (short, head, dots, tail)])


def compare_frequencies(before: DataFrame, after: DataFrame, include=None, exclude=None, ids=IDS) -> DataFrame:
    """Counts and ratios of each value before and after, side by side by value.

    Both tables go through one grouping, which also matches null with null.
    """
    counts = [
        frequencies(df, include, exclude, ids).withColumn("_after", F.lit(late))
        for df, late in ((before, False), (after, True))
    ]
    both = counts[0].unionByName(counts[1])
    paired = both.groupBy("column", "value").agg(
        F.sum(F.when(~F.col("_after"), F.col("count"))).alias("count_before"),
        F.sum(F.when(F.col("_after"), F.col("count"))).alias("count_after"),
    )
    # one row per column
    totals = F.broadcast(
        paired.groupBy("column").agg(
            F.sum("count_before").alias("_total_before"), F.sum("count_after").alias("_total_after")
        )
    )
    return paired.join(totals, "column").select(
        "column",
        "value",
        "count_before",
        (F.col("count_before") / F.col("_total_before")).alias("ratio_before"),
        "count_after",
        (F.col("count_after") / F.col("_total_after")).alias("ratio_after"),
    )


def distribution_report(
    before: DataFrame,
    after: DataFrame | None = None,
    include=None,
    exclude=None,
    max_rows: int | None = None,
    shorten: bool = False,
    sort_count: bool = True,
    column_info: Iterable[Mapping] | None = None,
    ids=IDS,
) -> DataFrame:
    """The listings before and after next to each other, line by line, per column.

    ``column_info`` entries ``{no, name, desc}`` restrict and order the columns and describe them.
    """
    info = list(column_info or [])

    def side(df: DataFrame, label: str) -> DataFrame:
        wanted = include or [i["name"].strip() for i in info] or None
        names = [c for c in wanted if c in df.columns] if wanted else None
        lines = listing(frequencies(df, names, exclude, ids), max_rows, shorten, sort_count)
        return lines.select(
            "column", "position", *[F.col(c).alias(f"{c}_{label}") for c in ("seq", "value", "count", "ratio")]
        )

    report = side(before, "before")
    if after is not None:
        report = report.join(side(after, "after"), ["column", "position"], "full_outer")
    if info:
        entries = [(int(i["no"]), i["name"].strip(), i.get("desc")) for i in info]
        known = before.sparkSession.createDataFrame(entries, "no int, column string, desc string")
        report = known.join(report, "column").select("no", "column", "desc", *report.columns[1:])
    return report


def sample_rows(
    df: DataFrame, groups: Sequence[Mapping] | None = None, default_filter=None, rn: str = "_rn"
) -> DataFrame:
    """The first ``count`` rows by id of each group ``{filter?, count}``; groups may overlap."""
    df = keep_where(df, default_filter)
    picked = [
        keep_where(df, g.get("filter")).orderBy(rn).limit(g["count"]) for g in (groups or [{"count": 5}])
    ]
    return reduce(DataFrame.union, picked)


def sample_compare(
    before: DataFrame,
    after: DataFrame | None = None,
    groups: Sequence[Mapping] | None = None,
    default_filter=None,
    rn: str = "_rn",
    jk: str = "_jk",
) -> DataFrame:
    """Sampled rows turned into lines ``name, sample_no, before, after``, matched on the row id.

    A column that exists on one side only has null on the other.
    """
    chosen = keep(sample_rows(before, groups, default_filter, rn), "sample")
    # as many rows as the groups ask for
    numbered = chosen.df.withColumn("sample_no", F.row_number().over(W.orderBy(rn)))
    numbered = keep(numbered, "sample-numbered").df
    lines = _as_lines(numbered, [c for c in before.columns], ["sample_no"]).withColumnRenamed("value", "before")
    if after is None:
        return lines.withColumn("after", F.lit(None).cast("string"))
    ids = numbered.select(rn, "sample_no")
    ids = F.broadcast(ids) if chosen.bytes <= BROADCAST_BYTES else ids
    found = after.drop(jk).join(ids, rn)
    # sampled rows without a counterpart keep their id only
    names = [rn, *[c for c in found.columns if c not in (rn, "sample_no")]]
    matched = numbered.select(rn, "sample_no").join(
        found.drop(rn), "sample_no", "left"
    )
    new = _as_lines(matched, names, ["sample_no"]).withColumnRenamed("value", "after")
    return lines.join(new, ["name", "sample_no"], "full_outer").select("name", "sample_no", "before", "after")


def sample_wide(lines: DataFrame, samples: int) -> DataFrame:
    """One line per column and, per sample, its value before and after: ``_c0_before, _c0_after...``"""
    cells = [
        F.max(F.when(F.col("sample_no") == i + 1, F.col(side))).alias(f"_c{i}_{side}")
        for i in range(samples)
        for side in ("before", "after")
    ]
    return lines.groupBy("name").agg(*cells)


def dataset_counts(tables: Mapping[str, DataFrame], rn: str = "_rn", with_size: bool = True) -> DataFrame:
    """``dataset, column_count, row_count`` and the bytes of the files, one row per table."""
    return reduce(DataFrame.unionByName, [_counted(n, df, rn, with_size) for n, df in tables.items()])


def _counted(name: str, df: DataFrame, rn: str, with_size: bool) -> DataFrame:
    columns = F.lit(len([c for c in df.columns if c != rn])).alias("column_count")
    label = F.lit(name).alias("dataset")
    if not with_size:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(label, columns, "row_count")
    files = df.groupBy(F.col("_metadata.file_path").alias("_path")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_metadata.file_size").alias("_bytes")
    )
    return files.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("filesize"),
    ).select(label, "filesize", columns, "row_count")


def survey(df: DataFrame, column_info: Iterable[Mapping], **profile_options) -> dict[str, DataFrame]:
    """Frequencies of the columns not marked ``x``, and profiles of those marked ``o``.

    ``column_info`` entries are ``{name, freq?, summary?}``.
    """
    info = list(column_info)
    listed = [i["name"] for i in info if str(i.get("freq") or "").lower() != "x"]
    profiled = [i["name"] for i in info if str(i.get("summary") or "").lower() == "o"]
    reports = {}
    if listed:
        reports["frequency"] = frequencies(df, listed)
    if profiled:
        reports["profile"] = numeric_profile(df, profiled, **profile_options)
    return reports


def _as_lines(df: DataFrame, columns: Sequence[str], ids: Sequence[str]) -> DataFrame:
    # prefixed so that a column may carry the name of an id
    text = df.select(*ids, *[F.col(quoted(c)).cast("string").alias(f"_v_{c}") for c in columns])
    long = text.unpivot(list(ids), [F.col(quoted(f"_v_{c}")) for c in columns], "name", "value")
    return long.withColumn("name", F.expr("substring(name, 4)"))


def _listing_order(sort_count: bool) -> list[Column]:
    return [F.col("count"), F.col("value")] if sort_count else [F.col("value"), F.col("count")]
