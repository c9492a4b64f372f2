"""Audit of CSV files: records that do not fit their schema, and types of text columns."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from veil.functions.longform import long_form, with_names
from veil.functions.templates import quoted
from veil.operators.identity import add_row_id
from veil.plans.tables import keep
from veil.sources.readers import read_csv
from veil.sources.schema import make_schema

CORRUPT = "_corrupt_record"
FILE = "_file"
SHOWN_LINES = 10


@dataclass(frozen=True)
class Audit:
    """The files as they parse, their bad records and their counts.

    ``rows`` is not stored: it parses the files again, with all columns. ``bad`` holds ``_file, _rn,
    _corrupt_record`` of the bad records only, ``counts`` the rows and bad records of each file and task.
    """

    rows: DataFrame
    bad: DataFrame
    counts: DataFrame

    def summary(self) -> DataFrame:
        """Rows and bad records per file."""
        return self.counts.groupBy(FILE).agg(
            F.sum("row_count").alias("row_count"), F.sum("corrupt_count").alias("corrupt_count")
        )

    def first_lines(self, count: int = SHOWN_LINES) -> DataFrame:
        """The first bad lines of each file."""
        first = W.partitionBy(FILE).orderBy("_rn")
        # the rank filter is applied before the shuffle too, so each task sends few lines
        return (
            self.bad.withColumn("line", F.row_number().over(first))
            .where(F.col("line") <= count)
            .select(FILE, "line", CORRUPT)
        )

    def is_clean(self) -> bool:
        return self.bad.isEmpty()

    def promote(self, path: str) -> bool:
        """Write the rows as the ingest table when no record is bad; tells whether it did."""
        if not self.is_clean():
            return False
        self.rows.drop(CORRUPT, FILE).write.mode("overwrite").parquet(path)
        return True


def audit_csv(
    spark: SparkSession,
    path: str,
    schema: str | StructType | Sequence[Mapping] | None = None,
    **settings,
) -> Audit:
    """Parse all columns of all files once, keeping the bad records and the counts.

    Without a schema all columns of the header are text, so that only records with too few or too
    many fields are bad. What is written grows with the bad records, not with the files.
    """
    if isinstance(schema, str):
        declared = StructType.fromDDL(schema)
    elif schema is None:
        declared = StructType([StructField(c, StringType()) for c in read_csv(spark, path, **settings).columns])
    else:
        declared = make_schema(schema)
    full = StructType([*declared.fields, StructField(CORRUPT, StringType())])
    bad_mode = {"schema": full, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = add_row_id(read_csv(spark, path, file_column=FILE, **(settings | bad_mode)))
    # a query that needs fewer columns would parse fewer, and miss bad values in the others
    used = F.xxhash64(*[F.col(quoted(c)) for c in declared.names])
    found = keep(parsed.select(FILE, "_rn", CORRUPT, used.alias("_used")).mapInArrow(_bad_and_counts, _FOUND), "audit").df
    bad = found.where("row_count IS NULL").select(FILE, "_rn", CORRUPT)
    return Audit(parsed, bad, found.where("row_count IS NOT NULL").select(FILE, "row_count", "corrupt_count"))


_FOUND = f"{FILE} string, _rn long, {CORRUPT} string, row_count long, corrupt_count long"


def _bad_and_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bad records of a task, and last its counts per file."""
    names = [FILE, "_rn", CORRUPT, "row_count", "corrupt_count"]
    rows, corrupt = Counter(), Counter()
    for batch in batches:
        files, is_bad = batch.column(0), batch.column(2).is_valid()
        for name in pc.value_counts(files).to_pylist():
            rows[name["values"]] += name["counts"]
        bad = batch.filter(is_bad)
        if bad.num_rows:
            for name in pc.value_counts(bad.column(0)).to_pylist():
                corrupt[name["values"]] += name["counts"]
            none = pa.nulls(bad.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*bad.columns[:3], none, none], names)
    if rows:
        n = len(rows)
        columns = [pa.array(list(rows), pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
        columns += [pa.array(rows.values(), pa.int64()), pa.array([corrupt[f] for f in rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names)


def _candidates(value: Column) -> dict[str, Column]:
    """Types in the order they are tried, with whether a value is of it; the first full fit wins.

    The form is checked before a cast, because a failing cast costs far more than a pattern.
    """
    number = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
    return {
        "long": F.when(value.rlike("^[+-]?[0-9]+$"), value.try_cast("bigint").isNotNull()),
        "double": value.rlike(number) | value.isin("NaN", "Infinity", "-Infinity"),
        "date": F.when(value.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), value.try_cast("date").isNotNull()),
        "timestamp": F.when(
            value.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}[ T][0-9]"), value.try_cast("timestamp").isNotNull()
        ),
    }


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The type of each text column as ``column, data_type, not_null``, from one pass over all rows.

    A column without values, or with any that fits no narrower type, is a string.
    """
    names = list(columns or df.columns)
    long = long_form(df, names, "string")
    parsed = _candidates(F.trim("value"))
    fits = [F.count_if(c).alias(t) for t, c in parsed.items()]
    counted = long.groupBy("column").agg(F.count("value").alias("not_null"), *fits)
    data_type = F.lit("string")
    for t in reversed(parsed):
        data_type = F.when(F.col(t) == F.col("not_null"), t).otherwise(data_type)
    return with_names(counted, names).select(
        "column",
        F.when(F.col("not_null") == 0, "string").otherwise(data_type).alias("data_type"),
        "not_null",
    )
