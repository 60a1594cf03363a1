from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def quoted(text: str) -> str:
    """A text (of the basic plane) as an SQL literal."""
    return "'" + "".join(c if c.isalnum() and c.isascii() else f"\\u{ord(c):04x}" for c in text) + "'"


def texts_of(values: Iterable[str]) -> str:
    """A literal array of texts as SQL."""
    return f"array({', '.join(map(quoted, values))})"


def map_of(pairs: Iterable[tuple[str, str]]) -> str:
    """A literal map from text to text as SQL."""
    return f"map({', '.join(quoted(x) for pair in pairs for x in pair)})"


def bound(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is computed
    once (inside lambda functions common expressions are not shared)."""
    return f"transform(array({value}), {name} -> {body})[0]"


def applied(value: Column, name: str, body: str) -> Column:
    """The same for a column: one SQL text instead of a Column call for each
    of its parts, which would take longer than most queries."""
    return F.get(F.call_function("transform", F.array(value), F.expr(f"{name} -> {body}")), F.lit(0))
