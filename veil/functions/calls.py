"""Functions of chain text: ``{#name}(arguments)`` as Spark SQL.

Some names mean something else in Spark SQL, or take any number of arguments, so a call is rewritten as
text from its arguments. A name that is not listed here is the function of Spark SQL.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_CALL = re.compile(r"\{#([^{}]+)\}")
_TYPE = re.compile(r"[A-Za-z_]+(\(\s*\d+\s*(,\s*\d+\s*)?\))?")


def _joined_digest(*parts: str) -> str:
    return f"sha2(concat_ws({', '.join(parts)}), 256)"


def _stepped(function: str) -> Callable[..., str]:
    """Rounding at a number of decimals; negative ones round to tens, hundreds..."""

    def call(x: str, digits: str = "0") -> str:
        return f"(CAST({function}(({x}) / pow(10D, -({digits}))) AS DOUBLE) * pow(10D, -({digits})))"

    return call


def _significant(x: str, digits: str, data_type: str = "'long'") -> str:
    unit = f"pow(10D, floor(log10(abs({x}))) - (({digits}) - 1))"
    return f"CAST(CASE WHEN ({x}) = 0 THEN 0D ELSE round(({x}) / {unit}) * {unit} END AS {_type(data_type)})"


def _uniform(low: str, high: str, data_type: str = "'long'") -> str:
    return f"(CAST(floor(rand() * (({high}) - ({low}) + 1)) AS {_type(data_type)}) + ({low}))"


CALLS: dict[str, Callable[..., str]] = {
    "sha256": _joined_digest,
    "sha256_concat": _joined_digest,
    "concat": lambda *parts: f"concat_ws('', {', '.join(parts)})",
    "ceil": _stepped("ceil"),
    "floor": _stepped("floor"),
    "round45": lambda x, digits="0": f"round({x}, {digits})",
    "rand_round": _significant,
    "rand_range": _uniform,
    "replace_string": lambda *parts: f"replace({', '.join(parts)})",
}


def _type(text: str) -> str:
    name = text.strip().strip("'\"").strip()
    if not _TYPE.fullmatch(name):
        raise ValueError(f"not a type name: {text}")
    return name


def expand_calls(text: str) -> str:
    """Rewrite every ``{#name}`` of a text, from the left, with the calls in its arguments."""
    match = _CALL.search(text)
    if not match:
        return text
    name, start = match[1], match.end()
    head, rest = text[: match.start()], text[start:]
    opened = re.match(r"\s*\(", rest)
    if name not in CALLS or not opened:
        return head + name + expand_calls(rest)
    arguments, end = _arguments(rest, opened.end())
    return head + CALLS[name](*map(expand_calls, arguments)) + expand_calls(rest[end:])


def _arguments(text: str, at: int) -> tuple[list[str], int]:
    """The arguments from behind an opening parenthesis, and the place behind its closing one."""
    found, depth, first, quote = [], 0, at, ""
    while at < len(text):
        c = text[at]
        if quote:
            if c == "\\" and quote != "`":
                at += 1
            elif c == quote:
                quote = ""
        elif c in "'\"`":
            quote = c
        elif c in "([{":
            depth += 1
        elif c in ")]}" and depth:
            depth -= 1
        elif c == ")" or (c == "," and not depth):
            found.append(text[first:at].strip())
            first = at + 1
            if c == ")":
                return ([] if found == [""] else found), at + 1
        at += 1
    raise ValueError(f"no closing parenthesis: {text}")
