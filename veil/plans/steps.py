"""The steps of a run as functions from table to table: ingest, prepare, de-identify, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veil.functions.templates import Chain, as_list, quoted
from veil.operators.chains import apply_chain, may_repeat_rows
from veil.operators.identity import add_row_id
from veil.operators.rewrite import keep_where
from veil.operators.suppress import keep_singletons
from veil.sources.readers import load_table

RN, JK = "_rn", "_jk"


def ingest(spark: SparkSession, storage: Mapping, rn: str = RN) -> DataFrame:
    """Load the input table and give its rows ids. Write it before joining on the ids."""
    return add_row_id(load_table(spark, storage, storage["filename"]), rn)


def prepare(df: DataFrame, config: Mapping | None) -> DataFrame:
    """Filter, rewrite columns in place, drop every copy of repeated keys, filter again."""
    config = config or {}
    df = keep_where(df, config.get("filter_in"))
    columns = config.get("column") or {}
    if columns:
        df = replace_columns(deidentify(df, columns), df.columns, columns)
    keys = as_list(config.get("remove_duplicated"))
    if keys:
        df = keep_singletons(df, keys, config.get("null_keys", "drop"))
    return keep_where(df, config.get("filter_out"))


def deidentify(df: DataFrame, columns: Mapping[str, Mapping]) -> DataFrame:
    """Add the chain columns of all configured columns to one plan; nothing is joined back.

    Chains do not see each other's results, so those that may repeat rows come last.
    """
    source, same_rows = df, True
    repeating = {c: any(map(may_repeat_rows, Chain.of(c, config).steps.values())) for c, config in columns.items()}
    for column in sorted(columns, key=repeating.get):
        df = apply_chain(df, column, columns[column], source, same_rows)
        same_rows = same_rows and not repeating[column]
    return df


def replace_columns(df: DataFrame, names: Sequence[str], columns: Mapping[str, Mapping]) -> DataFrame:
    """Put each chain's last value under its base name and drop the rest of the chain."""
    names = [*names, *[c for c in columns if c not in names]]
    return df.select(
        *[F.col(quoted(Chain.of(c, columns[c]).output if c in columns else c)).alias(c) for c in names]
    )


def publish(
    df: DataFrame,
    columns: Mapping[str, Mapping],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    filter_out: str | Sequence[str] | None = None,
    *,
    original: Sequence[str] | None = None,
    data_with_jk: bool = False,
    rn: str = RN,
    jk: str = JK,
) -> DataFrame:
    """Row id and the chosen columns, transformed where a chain exists, in the order of ``include``.

    Without ``include`` these are the ``original`` columns, or else all columns that are not ids or
    chain results. ``data_with_jk`` puts the linkage id first; without a chain it is left out.
    """
    if not include:
        include = original or [c for c in df.columns if c not in (rn, jk) and not c.startswith("_x_")]
    chosen = [c for c in include if c not in set(as_list(exclude)) and c != rn]
    if data_with_jk:
        chosen = [jk, *[c for c in chosen if c != jk]]
    if jk not in columns:
        chosen = [c for c in chosen if c != jk]
    picked = [c if c not in columns else Chain.of(c, columns[c]).output for c in chosen]
    published = df.select(rn, *[F.col(quoted(p)).alias(c) for p, c in zip(picked, chosen)])
    return keep_where(published, filter_out)


def reassemble(df: DataFrame, column_tables: Mapping[str, DataFrame], rn: str = RN) -> DataFrame:
    """Left-join externally made column tables ``(rn, column)`` back to their base rows.

    Row ids are unique on both sides, so the join keys cannot be skewed.
    """
    order = [*df.columns, *[c for c in column_tables if c not in df.columns]]
    df = df.drop(*column_tables)
    for column, table in column_tables.items():
        df = df.join(table.select(rn, column), rn, "left")
    return df.select(*order)
