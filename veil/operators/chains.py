"""The registry of chain operators and the loop that applies a chain."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veil.functions.templates import Chain, Step, as_list
from veil.operators import coding, persons, rewrite, suppress
from veil.operators.lookup import lookup
from veil.sources.readers import load_table

Operator = Callable[[DataFrame, Step], DataFrame]


def mapping(df: DataFrame, step: Step) -> DataFrame:
    """Look a value up in a table; a list of value columns gives one array.

    ``map`` names the table: ``table`` (a DataFrame), or ``directory`` and ``filename``, with its
    ``key`` and ``value`` columns.
    """
    where = step.config["map"]
    table = where.get("table")
    if table is None:
        table = load_table(df.sparkSession, where, where["filename"])
    value = where["value"]
    if isinstance(value, (list, tuple)):
        table = table.withColumn("_values", F.array(*value))
        value = "_values"
    match = [step.expr(m) for m in as_list(step.config["match"])]
    return lookup(df, table, match, as_list(where["key"]), {step.output: value}, unique=bool(where.get("unique")))


OPS: dict[str, Operator] = {
    "hash": rewrite.hash_value,
    "mapping": mapping,
    "person_counter": persons.person_counter,
    "person_noise": persons.person_noise,
    "person_noise_date": persons.person_noise_date,
    "noise": persons.noise,
    "noise_date": persons.noise_date,
    "replace_regexp": rewrite.replace_regexp,
    "replace": rewrite.replace,
    "local_delete": suppress.local_delete,
    "local_delete_groupby_count": suppress.local_delete,
    "local_delete_regexp": suppress.local_delete,
    "top_bottom_coding": coding.top_bottom_coding,
    "groupby_count": suppress.groupby_count,
}

def register_op(name: str, operator: Operator) -> None:
    """Make ``operator(df, step) -> df`` available to chains; it must write ``step.output``."""
    OPS[name] = operator


def may_repeat_rows(settings: Mapping) -> bool:
    """Whether a sub-step can repeat rows: a mapping whose keys are not required to be unique."""
    return settings["fn"] == "mapping" and not settings["map"].get("unique")


def apply_chain(
    df: DataFrame,
    column: str,
    config: Mapping,
    source: DataFrame | None = None,
    same_rows: bool = True,
) -> DataFrame:
    """Add the ``_x_{column}_{n}`` columns of one chain.

    ``source`` is the table before any chain; statistics of plain input columns are taken from it.
    ``same_rows`` tells that no earlier chain repeated rows of it.
    """
    chain = Chain.of(column, config)
    source = df if source is None else source
    scratch = []
    for number, settings in chain.steps.items():
        name = settings["fn"]
        if name not in OPS:
            raise ValueError(f"unknown operator {name!r}; known: {', '.join(sorted(OPS))}")
        step = Step(chain, number, settings, source, same_rows)
        df = OPS[name](df, step)
        if may_repeat_rows(settings):
            # what follows in this chain counts the rows as they are now
            source, same_rows = None, True
        scratch.append(step.noise)
    return df.drop(*scratch)
