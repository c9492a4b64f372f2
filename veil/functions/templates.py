"""Column chains: numbered sub-steps of a column and the templates that refer to them.

Sub-step ``n`` of column ``c`` writes ``_x_c_n``. In the expression text of a sub-step

* ``{0}`` is the base column, ``{n}`` the result of sub-step n, ``{-k}`` the k-th sub-step before,
* ``{$i}`` is the i-th auxiliary column of the chain (key ``cols``),
* ``{#f}(...)`` is the function ``f`` of chain text, see :mod:`veil.functions.calls`, else that of Spark SQL.

What remains is SQL, parsed by Catalyst.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veil.functions.calls import expand_calls

_TOKEN = re.compile(r"\{(?:(?P<sub>-?\d+)|\$(?P<aux>\d+)|#(?P<function>[^{}]+))\}")


def chain_column(column: str, number: int | str) -> str:
    return f"_x_{column}_{number}"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_list(value) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


@dataclass(frozen=True)
class Chain:
    """The configuration of one column: auxiliary columns and ordered sub-steps."""

    column: str
    aux: tuple[str, ...]
    steps: dict[int, Mapping[str, Any]]

    @classmethod
    def of(cls, column: str, config: Mapping) -> Chain:
        steps = {int(k): v for k, v in config.items() if str(k).isdigit()}
        if not steps:
            raise ValueError(f"column {column!r} has no numbered sub-step")
        return cls(column, tuple(as_list(config.get("cols"))), dict(sorted(steps.items())))

    @property
    def output(self) -> str:
        """Name of the column that holds the published value."""
        return chain_column(self.column, max(self.steps))


@dataclass(frozen=True)
class Step:
    """One sub-step while it is applied."""

    chain: Chain
    number: int
    config: Mapping[str, Any] = field(default_factory=dict)
    source: DataFrame | None = None
    """The chain's input, from which statistics of its columns are taken."""
    same_rows: bool = True
    """Whether the table being transformed still has the input's rows, none of them repeated."""

    @property
    def column(self) -> str:
        return self.chain.column

    @property
    def output(self) -> str:
        return chain_column(self.column, self.number)

    @property
    def noise(self) -> str:
        return f"_x_noise_{self.number}"

    def reference(self, token: int) -> str:
        if token > 0:
            return chain_column(self.column, token)
        if token == 0:
            return self.column
        earlier = [n for n in self.chain.steps if n < self.number]
        if -token > len(earlier):
            raise ValueError(f"{{{token}}} in sub-step {self.number} of {self.column!r} is before the first one")
        return chain_column(self.column, earlier[token])

    def text(self, template: Any) -> str:
        """The SQL text of a template."""

        def fill(match: re.Match) -> str:
            if match["function"]:
                return match[0]
            if match["aux"]:
                return quoted(self.chain.aux[int(match["aux"])])
            return quoted(self.reference(int(match["sub"])))

        return expand_calls(_TOKEN.sub(fill, str(template)))

    def expr(self, value: Any) -> Column:
        """A column from SQL template text; columns and functions of the step pass through."""
        if isinstance(value, Column):
            return value
        if callable(value):
            return value(self)
        return F.lit(value) if value is None else F.expr(self.text(value))

    def name(self, template: Any) -> str | None:
        """The plain column name a template stands for, or None when it is an expression."""
        if not isinstance(template, str):
            return None
        text = self.text(template).strip()
        if text.startswith("`") and text.endswith("`") and "`" not in text[1:-1]:
            return text[1:-1]
        return text if re.fullmatch(r"\w+", text) else None

    def stats_frame(self, df: DataFrame, *templates: Any) -> DataFrame:
        """Where to take statistics of these values from.

        Plain input columns are read from the chain's input, so that Catalyst prunes the scan to
        them and repeats none of the sub-steps already applied.
        """
        if self.source is None:
            return df
        names = [self.name(t) for t in templates]
        return self.source if all(n in self.source.columns for n in names) else df
