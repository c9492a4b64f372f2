"""Declared schemas and cast projections."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from veil.functions.scalar import parse_number
from veil.functions.templates import quoted

_TYPES = {
    "str": StringType, "string": StringType,
    "int": IntegerType, "integer": IntegerType, "long": LongType,
    "float": FloatType, "double": DoubleType,
    "date": DateType, "timestamp": TimestampType,
}
_NUMBERS = {"int", "integer", "long", "float", "double"}


def make_schema(columns: Iterable[Mapping] | StructType | None) -> StructType | None:
    """A schema from ``{name, data_type, nullable, precision?, scale?}`` entries."""
    if not columns or isinstance(columns, StructType):
        return columns or None
    return StructType([StructField(c["name"], _data_type(c), c.get("nullable", True)) for c in columns])


def _data_type(column: Mapping) -> DataType:
    name = column["data_type"].lower()
    if name.startswith("dec"):
        return DecimalType(column["precision"], column["scale"])
    if name not in _TYPES:
        raise ValueError(f"unknown data type {name!r} of column {column['name']!r}")
    return _TYPES[name]()


def cast_columns(df: DataFrame, types: Mapping[str, str] | None = None, default: str = "string") -> DataFrame:
    """Cast text columns in one projection; what does not parse becomes null.

    Numbers may carry thousands separators.
    """
    types = types or {}
    return df.select(*[_cast(F.col(quoted(c)), types.get(c, default)).alias(c) for c in df.columns])


def _cast(column: Column, data_type: str) -> Column:
    if data_type in _NUMBERS:
        return parse_number(column, data_type)
    return column if data_type == "string" else column.try_cast(data_type)
