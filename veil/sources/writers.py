"""Sinks: Parquet and CSV tables, the published data, and the crosswalk of linkage ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.functions.templates import Chain, quoted
from veil.sources.readers import _OWN_KEYS


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(str(path))


def write_csv(
    df: DataFrame,
    path: str,
    order_by: Sequence[Mapping[str, str]] = (),
    single_file: bool = False,
    **settings,
) -> None:
    """Write a CSV table. ``order_by`` is a list of ``{column: 'asc' | 'desc'}``.

    The order holds over the part files taken by name. ``single_file`` writes one part through one
    task, whatever the size; ask for it for reports only.
    """
    options = {"header": True, "escape": '"'}
    options |= {k: v for k, v in settings.items() if k not in _OWN_KEYS and k != "mode" and v is not None}
    keys = [
        F.col(quoted(c)).desc() if direction == "desc" else F.col(quoted(c)).asc()
        for entry in order_by
        for c, direction in entry.items()
    ]
    if single_file:
        df = df.coalesce(1)
        df = df.sortWithinPartitions(*keys) if keys else df
    elif keys:
        df = df.orderBy(*keys)
    df.write.mode("overwrite").options(**options).csv(str(path))


def save_table(df: DataFrame, storage: Mapping[str, Any], filename: str) -> str:
    """Write ``directory/filename`` as Parquet or CSV by its name, replacing what is there."""
    path = f"{storage['directory']}/{filename}"
    if filename.endswith(".parquet"):
        write_parquet(df, path)
    else:
        settings = {k: v for k, v in storage.items() if k not in ("orderby", "make_1_file")}
        write_csv(df, path, storage.get("orderby") or (), bool(storage.get("make_1_file")), **settings)
    return path


def export_rows(df: DataFrame, rn: str = "_rn", with_linkage: bool = False) -> DataFrame:
    """The published table as it leaves: without row ids when it carries linkage ids."""
    return df.drop(rn) if with_linkage else df


def crosswalk(df: DataFrame, config: Mapping, rn: str = "_rn", jk: str = "_jk") -> DataFrame:
    """Row id to linkage id: the last chain value of the linkage column."""
    return df.select(rn, F.col(quoted(Chain.of(jk, config).output)).alias(jk))
