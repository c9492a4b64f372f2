"""Left lookups and group sizes that never send a frequent key to one task."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from veil.functions.templates import quoted
from veil.plans import tables
from veil.plans.tables import Kept, keep, measure

COUNT = "_traffic"
_SALT, _SERVED, _VALUE = "_salt", "_served", "_value_"
_ROW_SLICES, _ENTRY_SLICES = "_row_slices", "_entry_slices"
# Rows of a frequent key are dealt into so many parts at least.
_SALTS = 256
# Partial sketches are merged in this many tasks before the last one.
_SKETCH_GROUPS = 64


def lookup(
    df: DataFrame,
    table: DataFrame | Kept,
    match: Sequence[str | Column],
    keys: Sequence[str],
    values: dict[str, str],
    *,
    unique: bool = False,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Left join on null-safe key equality, adding ``values`` (new name -> table column).

    A table measured to be small (``broadcast_bytes``) is broadcast. For a larger one the keys that many rows of ``df``
    share are found first: their entries are broadcast, while their rows are salted through the
    shuffle join that serves all other keys. Where those entries are too many for that, rows and
    entries of a frequent key are cut into slices and meet in a grid. Repeated keys in the table repeat rows, as in any left
    join, unless ``unique`` asks for an error.
    """
    if len(match) != len(keys):
        raise ValueError(f"{len(match)} match columns for {len(keys)} key columns: {keys}")
    probe, own = _with_keys(df, match)
    names = [f"_k{i}" for i in range(len(keys))]
    raw = table.df if isinstance(table, Kept) else table
    slim = raw.select(
        *[F.col(quoted(k)).alias(n) for k, n in zip(keys, names)],
        *[F.col(quoted(v)).alias(_VALUE + new) for new, v in values.items()],
    )
    if unique and not slim.groupBy(*names).count().where("count > 1").isEmpty():
        raise ValueError("the lookup table repeats keys")
    # a value takes the place of a column that has its name
    columns = [F.col(quoted(c)) for c in df.columns if c not in values]
    found = [F.col(quoted(_VALUE + v)).alias(v) for v in values]

    limit = tables.BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if (table if isinstance(table, Kept) else measure(slim)).bytes <= limit:
        return probe.join(F.broadcast(slim), _equal(own, names), "left").select(*columns, *found)

    probe_hash, table_hash = _hashes(probe, own, slim, names)
    hot = _traffic(probe.select(probe_hash.alias("h")))
    if hot:
        entries = keep(_prefixed(slim.where(table_hash.isin(hot)), _SERVED), "hot-entries")
    if not hot:
        return probe.join(slim, _equal(own, names), "left").select(*columns, *found)
    salt = F.when(probe_hash.isin(hot), _row_salt(df) + 1).otherwise(0).cast("long")
    if entries.bytes > limit:
        joined = _grid_join(probe, own, probe_hash, entries.df, slim, names, hot)
        return joined.select(*columns, *found)

    # rows of hot keys get a salt that matches nothing, so they spread over the shuffle
    # always 0, but no constant: a constant would turn the salt from a shuffle key into a filter
    cold = slim.withColumn("_cold", F.pmod(table_hash, F.lit(1).cast("long")))
    joined = (
        probe.withColumn(_SALT, salt)
        .join(cold, _equal(own, names) & (F.col(_SALT) == F.col("_cold")), "left")
        .join(
            F.broadcast(entries.df), _equal(own, [_SERVED + n for n in names]) & (F.col(_SALT) > 0), "left"
        )
    )
    return joined.select(
        *columns,
        *[
            F.when(F.col(_SALT) > 0, F.col(quoted(_SERVED + _VALUE + v))).otherwise(F.col(quoted(_VALUE + v))).alias(v)
            for v in values
        ],
    )


def lookup_totals(
    df: DataFrame,
    table: DataFrame,
    match: Sequence[str | Column],
    keys: Sequence[str],
    totals: dict[str, Column],
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Left join on null-safe key equality, adding ``totals`` (new name -> aggregate over the entries of the row's key).

    The entries are combined per key before they meet the rows, with partial results per task, so that a key frequent
    on both sides costs its rows and its entries, not their product. Each row stays one row.
    """
    if len(match) != len(keys):
        raise ValueError(f"{len(match)} match columns for {len(keys)} key columns: {keys}")
    own = df.select(*[_column(m).alias(f"_m{i}") for i, m in enumerate(match)])
    # of the type in which keys are compared, since keys that differ in their own may be equal there
    names = [f"_k{i}" for i in range(len(keys))]
    types = [_common_type(df.sparkSession, a.dataType, table.schema[k].dataType) for a, k in zip(own.schema.fields, keys)]
    grouped = table.groupBy(*[F.col(quoted(k)).cast(t).alias(n) for k, t, n in zip(keys, types, names)])
    # the names of the keys may be those of the totals
    combined = grouped.agg(*[c.alias(f"_t{i}") for i, c in enumerate(totals.values())])
    values = {new: f"_t{i}" for i, new in enumerate(totals)}
    return lookup(df, combined, match, names, values, broadcast_bytes=broadcast_bytes)


def _grid_join(
    probe: DataFrame, own: list[str], probe_hash: Column, entries: DataFrame, slim: DataFrame, names: list[str], hot: list[int]
) -> DataFrame:
    """Left join where some keys are frequent on both sides.

    The rows and the entries of such a key are cut into slices of a fair share at most, and each pair of
    slices meets in a cell of its own: a row is copied once per slice of entries, an entry once per slice of rows.
    """
    rows = probe.where(probe_hash.isin(hot)).groupBy(*own).agg(F.count(F.lit(1)).alias("_rows"))
    served = [_SERVED + n for n in names]
    listed = entries.groupBy(*served).agg(F.count(F.lit(1)).alias("_entries"))
    share = F.greatest(F.floor(F.lit(measure(probe.select(*own)).rows) / _partitions(probe)), F.lit(1))
    slices = [F.ceil(F.col(c) / share).cast("long").alias(n) for c, n in (("_rows", _ROW_SLICES), ("_entries", _ENTRY_SLICES))]
    # at most one key per shuffle partition is that frequent
    grid = keep(rows.join(listed, _equal(own, served)).select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(own)], *slices), "grid").df
    grid_keys = [f"_g{i}" for i in range(len(own))]

    dealt_rows = probe.join(F.broadcast(grid), _equal(own, grid_keys), "left").drop(*grid_keys)
    gridded = F.col(_ROW_SLICES).isNotNull()
    # frequent keys without an entry get a slice that matches nothing
    slice_of_row = F.when(gridded, F.pmod(_row_hash(probe), F.col(_ROW_SLICES))).when(
        probe_hash.isin(hot), -1 - _row_salt(probe)
    ).otherwise(F.lit(0).cast("long"))
    dealt_rows = dealt_rows.withColumn("_at", slice_of_row).withColumn(
        "_with", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(_ENTRY_SLICES, F.lit(1).cast("long")) - 1))
    )
    dealt = slim.join(F.broadcast(grid), _equal(names, grid_keys), "left").drop(*grid_keys)
    slice_of_entry = F.when(gridded, F.pmod(_row_hash(slim), F.col(_ENTRY_SLICES))).otherwise(F.lit(0).cast("long"))
    dealt = dealt.withColumn("_slice", slice_of_entry).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(_ROW_SLICES, F.lit(1).cast("long")) - 1))
    ).drop(_ROW_SLICES, _ENTRY_SLICES)
    cell = (F.col("_at") == F.col("_copy")) & (F.col("_with") == F.col("_slice"))
    joined = dealt_rows.join(dealt, _equal(own, names) & cell, "left")
    # a slice may be empty, but a key of the grid has an entry in another one
    return joined.where(~gridded | F.col("_copy").isNotNull())


def group_counts(df: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Rows per group as ``_k0.., _traffic``; partial counts are formed before the shuffle."""
    keys = [_column(b).alias(f"_k{i}") for i, b in enumerate(by)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COUNT))


def hot_groups(counts: DataFrame) -> DataFrame:
    """The groups above the fair share of a shuffle partition, at most one per partition."""
    total = counts.agg(F.sum(COUNT)).scalar()
    return counts.where(F.col(COUNT) * _partitions(counts) > total)


def attach_group_count(
    df: DataFrame,
    by: Sequence[str | Column],
    out: str,
    *,
    null_keys: str = "null",
    source: DataFrame | None = None,
    same_rows: bool = True,
) -> DataFrame:
    """Add the size of each row's group (k-anonymity cell size).

    ``null_keys='null'`` gives null where any key part is null; ``'group'`` counts nulls together.
    Groups are counted in ``source`` (default ``df``); ``same_rows`` tells that it holds as many
    rows of each group as ``df`` does. Few groups are counted and broadcast. Many are counted in
    the one shuffle of a window, where groups that would fill a task are split.
    """
    if null_keys not in ("null", "group"):
        raise ValueError(f"null_keys must be 'null' or 'group', not {null_keys!r}")
    source = df if source is None else source
    keyed, own = _with_keys(source, by)
    own_hash = F.xxhash64(*own)
    # a count of distinct hashes is far cheaper than the sketch of frequent ones, which few groups do not need
    groups = keyed.agg(F.approx_count_distinct(own_hash)).first()[0] if same_rows else 0
    if groups * tables.VALUE_OVERHEAD * (len(own) + 1) <= tables.BROADCAST_BYTES:
        counts = keep(group_counts(source, by), "group-counts")
        if counts.small or not same_rows:
            counted = lookup(df, counts, by, [f"_k{i}" for i in range(len(own))], {out: COUNT})
            return _null_without_key(counted, by, out) if null_keys == "null" else counted
    frequent = _traffic(keyed.select(own_hash.alias("h")))
    hot = keep(group_counts(keyed.where(own_hash.isin(frequent)), own), "hot-groups").df if frequent else None
    counted = count_in_window(df, by, out, hot)
    return _null_without_key(counted, by, out) if null_keys == "null" else counted


def count_in_window(df: DataFrame, by: Sequence[str | Column], out: str, hot: DataFrame | None) -> DataFrame:
    """Group sizes, nulls counted together, with one shuffle of the rows.

    ``hot`` holds the counts of the few groups too large for a task. Their rows take the count from
    there and are split over the shuffle by the task they come from.
    """
    keyed, own = _with_keys(df, by)
    columns = [F.col(quoted(c)) for c in df.columns if c != out]
    if hot is None:
        return keyed.select(*columns, F.count(F.lit(1)).over(W.partitionBy(*own)).alias(out))
    known = _prefixed(hot, _SERVED)
    names = [_SERVED + f"_k{i}" for i in range(len(own))]
    # at most one row per shuffle partition
    marked = keyed.join(F.broadcast(known), _equal(own, names), "left")
    is_hot = F.col(_SERVED + COUNT).isNotNull()
    salted = marked.withColumn(_SALT, F.when(is_hot, _row_salt(df) + 1).otherwise(0))
    counted = F.count(F.lit(1)).over(W.partitionBy(*own, _SALT))
    return salted.select(*columns, F.coalesce(F.col(_SERVED + COUNT), counted).alias(out))


def _row_hash(df: DataFrame) -> Column:
    """A hash of each row from its values and its task: a retried task repeats it, and equal rows of other tasks differ."""
    values = [F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.spark_partition_id(), *values)


def _row_salt(df: DataFrame) -> Column:
    """A part for each row; a key of any share fills no more than a quarter of a shuffle partition with one part."""
    return F.pmod(_row_hash(df), F.lit(max(_SALTS, 4 * _partitions(df))).cast("long"))


def _traffic(hashes: DataFrame) -> list[int]:
    """The hashes ``h`` that hold more rows than the fair share of a shuffle partition, by a sketch.

    It is merged in two levels, with bounded memory throughout. It picks a plan; every plan is exact.
    """
    partitions = _partitions(hashes)
    tracked = min(max(4096, 8 * partitions), 65536)
    sketches = hashes.groupBy(F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("g")).agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("items"),
    )
    # grouped, since sketches of no rows cannot be combined
    row = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.sum("n").alias("n"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(items, {tracked}), {min(partitions, tracked)})").alias("top"),
    ).first()
    if row is None:
        return []
    return [t["item"] for t in row["top"] if t["count"] * partitions > row["n"]]


def _hashes(left: DataFrame, own: Sequence[str], right: DataFrame, names: Sequence[str]) -> tuple[Column, Column]:
    """Hashes of both sides' keys that agree wherever the keys compare as equal."""
    pairs = []
    for m, n in zip(own, names):
        common = _common_type(left.sparkSession, left.schema[m].dataType, right.schema[n].dataType)
        columns = [F.col(c).cast(common) for c in (m, n)]
        if common.typeName() in ("float", "double"):
            columns = [c + F.lit(0.0) for c in columns]  # one zero
        pairs.append(columns)
    return F.xxhash64(*[p[0] for p in pairs]), F.xxhash64(*[p[1] for p in pairs])


def _common_type(spark: SparkSession, *types: DataType) -> DataType:
    """The type in which values of these types are compared."""
    both = F.coalesce(*[F.lit(None).cast(t) for t in types]).alias("c")
    return spark.range(1).select(both).schema["c"].dataType


def _with_keys(df: DataFrame, match: Sequence[str | Column]) -> tuple[DataFrame, list[str]]:
    own = [f"_m{i}" for i in range(len(match))]
    return df.withColumns(dict(zip(own, map(_column, match)))), own


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(quoted(c)).alias(prefix + c) for c in df.columns])


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _null_without_key(df: DataFrame, by: Sequence[str | Column], out: str) -> DataFrame:
    present = reduce(lambda a, b: a & b, [_column(b).isNotNull() for b in by])
    return df.withColumn(out, F.when(present, F.col(out)))


def _equal(left: Iterable[str], right: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(n)) for m, n in zip(left, right)])


def _column(c: str | Column) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c
