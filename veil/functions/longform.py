"""Columns turned into rows, so that one grouping serves all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.functions.templates import quoted

COLUMN, VALUE = "column", "value"


def long_form(df: DataFrame, columns: Sequence[str], data_type: str) -> DataFrame:
    """``(column, value)`` rows of the given type; ``column`` is the place in ``columns``.

    A number instead of the name keeps the grouping keys short in the hash tables and the shuffle.
    """
    cells = F.array(*[F.col(quoted(c)).cast(data_type) for c in columns])
    return df.select(F.posexplode(cells).alias(COLUMN, VALUE))


def with_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Put the column's name in place of its number."""
    name = F.element_at(F.array(*map(F.lit, columns)), F.col(COLUMN) + 1)
    return df.withColumn(COLUMN, name)
