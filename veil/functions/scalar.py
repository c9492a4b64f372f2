"""Column functions for expressions, all built from native Spark functions.

Use them from Python, or call :func:`register_sql_functions` once per session to use the
fixed-arity ones by name inside the SQL text of a chain configuration.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def sha256_concat(separator: str, *cols) -> Column:
    """Hex SHA-256 of the separator-joined values; nulls are skipped."""
    return F.sha2(F.concat_ws(separator, *cols), 256)


def concat_present(*cols) -> Column:
    """Concatenation that skips nulls instead of returning null."""
    return F.concat_ws("", *cols)


def ceil_to(col, digits: int) -> Column:
    """Ceiling at ``digits`` decimals; negative digits round to tens, hundreds..."""
    unit = F.pow(F.lit(10.0), F.lit(-digits))
    return F.ceil(_col(col) / unit) * unit


def floor_to(col, digits: int) -> Column:
    """Floor at ``digits`` decimals; negative digits round to tens, hundreds..."""
    unit = F.pow(F.lit(10.0), F.lit(-digits))
    return F.floor(_col(col) / unit) * unit


def round_half_up(col, digits: int = 0) -> Column:
    return F.round(_col(col), digits)


def round_significant(col, digits: int, data_type: str = "long") -> Column:
    """Keep ``digits`` significant digits, half up, in double precision; 0 stays 0, null stays null."""
    x = _col(col).cast("double")
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))) - (digits - 1))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x / unit) * unit).cast(data_type)


def replace_text(col, old: str, new: str) -> Column:
    return F.replace(_col(col), F.lit(old), F.lit(new))


def parse_date(col, fmt: str | None = None) -> Column:
    """Date of a text, null where the text is not a date (ANSI mode would raise)."""
    return F.try_to_date(_col(col), fmt) if fmt else F.try_to_date(_col(col))


def parse_number(col, data_type: str) -> Column:
    """Number of a text with thousands separators, null where it is no number."""
    return F.replace(_col(col).cast("string"), F.lit(","), F.lit("")).try_cast(data_type)


def random_between(low: int, high: int, data_type: str = "long") -> Column:
    """Uniform integer in ``[low, high]``, drawn anew per row and per run."""
    return F.floor(F.rand() * (high - low + 1)).cast(data_type) + F.lit(low).cast(data_type)


def keyed_between(low: int, high: int, seed, purpose: str, *keys) -> Column:
    """Uniform integer in ``[low, high]`` fixed by a secret seed and the key columns.

    The same key gets the same number in every run and on every retry of a task, with no table to
    keep and no join. ``purpose`` makes several numbers of one key independent.
    """
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), *[_col(k).cast("string") for k in keys])
    word = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")
    return F.lit(low).cast("long") + F.pmod(word, F.lit(high - low + 1).cast("long"))


# SQL functions by the names a chain configuration uses. Catalyst inlines their bodies.
_SQL_FUNCTIONS = {
    "round45(x DOUBLE, y INT) RETURNS DOUBLE": "round(x * pow(10D, y)) / pow(10D, y)",
    "ceil_to(x DOUBLE, y INT) RETURNS DOUBLE": "ceil(x / pow(10D, -y)) * pow(10D, -y)",
    "floor_to(x DOUBLE, y INT) RETURNS DOUBLE": "floor(x / pow(10D, -y)) * pow(10D, -y)",
    "rand_round(x DOUBLE, y INT) RETURNS BIGINT": (
        "CAST(CASE WHEN x = 0 THEN 0D ELSE "
        "round(x / pow(10D, floor(log10(abs(x))) - (y - 1))) * pow(10D, floor(log10(abs(x))) - (y - 1)) "
        "END AS BIGINT)"
    ),
    "rand_range(x BIGINT, y BIGINT) RETURNS BIGINT": "CAST(floor(rand() * (y - x + 1)) AS BIGINT) + x",
    "replace_string(s STRING, a STRING, b STRING) RETURNS STRING": "replace(s, a, b)",
    "sha256_concat(sep STRING, parts ARRAY<STRING>) RETURNS STRING": "sha2(concat_ws(sep, parts), 256)",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the helpers callable from SQL text in this session."""
    for head, body in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
