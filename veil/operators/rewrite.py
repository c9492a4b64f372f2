"""Row-local rewriting: hashing, regular expressions, CASE, null columns, select blocks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.digest import salted_hash
from veil.functions.templates import Step, as_list, quoted


def hash_value(df: DataFrame, step: Step) -> DataFrame:
    """Salted digest. A salt is required; an empty one must be given as ''."""
    if step.config.get("salt") is None:
        raise ValueError(f"hash of {step.column!r} needs a salt")
    digest = salted_hash(
        step.expr(step.config["origin"]),
        step.config["salt"],
        bool(step.config.get("salt_first")),
        step.config.get("algorithm") or "SHA256",
        step.config.get("encode") or "hex",
        step.config.get("bytes"),
    )
    return df.withColumn(step.output, digest)


def replace_regexp(df: DataFrame, step: Step) -> DataFrame:
    """Apply (pattern, replacement) pairs in sequence. Patterns are taken as they are."""
    value = step.expr(step.config["match"])
    for rule in step.config["expr"]:
        value = F.regexp_replace(value, F.lit(rule["c"]), F.lit(rule["v"]))
    return df.withColumn(step.output, value)


def replace(df: DataFrame, step: Step) -> DataFrame:
    """Ordered CASE branches: condition ``c``, or regex ``r`` found in ``c``, gives ``v``."""
    data_type = step.config.get("type")

    def typed(value) -> Column:
        column = step.expr(value)
        return column.cast(data_type) if data_type else column

    result = None
    for rule in as_list(step.config.get("expr")):
        condition = step.expr(rule["c"])
        if rule.get("r") is not None:
            condition = condition.rlike(rule["r"])
        value = typed(rule.get("v"))
        result = F.when(condition, value) if result is None else result.when(condition, value)
    otherwise = typed(step.config.get("else"))
    return df.withColumn(step.output, otherwise if result is None else result.otherwise(otherwise))


def add_null_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("string") for c in columns})


def keep_where(df: DataFrame, predicates: str | Iterable[str] | None) -> DataFrame:
    """Filter by one SQL predicate or by all of a list."""
    for predicate in as_list(predicates):
        df = df.where(predicate)
    return df


def select_block(
    df: DataFrame,
    filter: str | Iterable[str] | None = None,
    groupby_count: Iterable[str] | None = None,
    column: Mapping[str, str] | Iterable[Mapping[str, str]] | None = None,
) -> DataFrame:
    """Filter, then count groups, then project ``{new: old}``; every part is optional."""
    df = keep_where(df, filter)
    if groupby_count:
        df = df.groupBy(*groupby_count).count()
    if column:
        pairs = column if isinstance(column, Mapping) else {k: v for d in column for k, v in d.items()}
        df = df.select(*[F.col(quoted(old)).alias(new) for new, old in pairs.items()])
    return df


def pad_code(code: Column, width: int = 5) -> Column:
    """Right-pad with zeros; longer codes stay as they are."""
    return F.when(F.length(code) < width, F.rpad(code, width, "0")).otherwise(code)


# The column headers of the published occupation table.
OCCUPATION_HEADERS = {"code": "코드", "name_ko": "국문 항목명", "name_en": "영문 항목명"}


def occupation_codes(df: DataFrame, headers: Mapping[str, str] = OCCUPATION_HEADERS) -> DataFrame:
    """The mapping table of occupation codes: five-digit code and names."""
    renamed = select_block(df, column=headers)
    return renamed.withColumn("code", pad_code(F.col("code")))
