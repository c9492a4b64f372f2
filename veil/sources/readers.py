"""Scans: Parquet and CSV, one file or many, with casts and filters applied on load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from veil.operators.rewrite import keep_where
from veil.sources import quoted
from veil.sources.schema import cast_columns, make_schema

# Settings of a storage entry that are ours, not options of the CSV source.
_OWN_KEYS = {
    "directory", "filename", "filetype", "files", "filter", "key", "make_1_file", "orderby", "schema",
    "single_file", "step", "storage", "table", "type_cast", "type_cast_default", "unique", "value",
}


def csv_options(settings: Mapping[str, Any]) -> dict[str, Any]:
    """CSV read options: quoted quotes, both trims, and a mode that depends on the schema."""
    defaults = {
        "header": True,
        "escape": '"',
        "multiLine": settings.get("multiline", False),
        "mode": "PERMISSIVE" if settings.get("schema") else "FAILFAST",
        "ignoreLeadingWhiteSpace": True,
        "ignoreTrailingWhiteSpace": True,
    }
    given = {k: v for k, v in settings.items() if k not in _OWN_KEYS and k != "multiline" and v is not None}
    return defaults | given


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*map(str, paths))


def read_csv(spark: SparkSession, path: str | Sequence[str], file_column: str | None = None, **settings) -> DataFrame:
    """Read CSV files; ``file_column`` adds the file of each row.

    Files with line breaks in quotes (``multiline``) are read in ranges by many tasks, unless types are to
    be guessed or the text is not UTF-8.
    """
    options, path = csv_options(settings), path if isinstance(path, list) else str(path)
    schema = settings.get("schema")
    if schema:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else make_schema(schema)
    if str(options["multiLine"]).lower() == "true" and quoted.splittable(options):
        df = quoted.read_records(spark, path, options, schema or None)
        return df.withColumnRenamed(quoted.FILE, file_column) if file_column else df.drop(quoted.FILE)
    reader = spark.read.options(**options)
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select("*", F.col("_metadata.file_path").alias(file_column)) if file_column else df


def load_table(spark: SparkSession, storage: Mapping[str, Any], filename: str | Sequence[str]) -> DataFrame:
    """Load ``directory/filename`` as Parquet or CSV, then cast and filter.

    Several files, from a pattern or a list, are matched by column name unless a schema is given.
    """
    names = [filename] if isinstance(filename, str) else list(filename)
    tables = [_scan(spark, storage, name) for name in names]
    df = tables[0]
    for other in tables[1:]:
        df = df.unionByName(other)
    if not storage.get("schema") and (storage.get("type_cast") or storage.get("type_cast_default")):
        df = cast_columns(df, storage.get("type_cast"), storage.get("type_cast_default") or "string")
    return keep_where(df, storage.get("filter"))


def create_table(
    spark: SparkSession,
    rows: Sequence,
    schema: str | StructType | Sequence[Mapping] | None = None,
    columns: Sequence[str] = (),
) -> DataFrame:
    """A table from local rows with a schema or with column names."""
    if schema:
        known = schema if isinstance(schema, (str, StructType)) else make_schema(schema)
        return spark.createDataFrame(rows, schema=known)
    return spark.createDataFrame(rows).toDF(*columns)


def _scan(spark: SparkSession, storage: Mapping[str, Any], name: str) -> DataFrame:
    path = f"{storage['directory']}/{name}"
    if name.endswith(".parquet"):
        return read_parquet(spark, path)
    by_position = storage.get("schema") or not csv_options(storage)["header"]
    if by_position or not any(c in name for c in "*?"):
        return read_csv(spark, path, **storage)
    return _read_by_header(spark, path, storage)


def _read_by_header(spark: SparkSession, pattern: str, storage: Mapping[str, Any]) -> DataFrame:
    """Files that may order their columns differently: one scan per distinct header, for any number of files."""
    options = csv_options(storage)
    raw = {k: v for k, v in options.items() if k in ("encoding", "charset", "lineSep")}
    text = spark.read.options(**raw).text(pattern).where("_metadata.file_block_start = 0 AND trim(value) <> ''")
    if options.get("comment"):
        text = text.where(~F.col("value").startswith(options["comment"]))
    # the first line of each file; a task forms it before the shuffle
    placed = text.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("line"))
    first = placed.groupBy("path").agg(F.min_by("value", "line").alias("header"))
    groups = [r["paths"] for r in first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()]
    if len(groups) <= 1:
        return read_csv(spark, pattern, **storage)
    scans = [read_csv(spark, files, **storage) for files in sorted(groups)]
    df = scans[0]
    for other in scans[1:]:
        df = df.unionByName(other)
    return df
