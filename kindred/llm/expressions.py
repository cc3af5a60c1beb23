"""Column helpers shared by the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where a lambda uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def only(df: DataFrame, *names: str) -> DataFrame:
    """The columns ``names`` alone, also where others have the same name in other letters."""
    return _renamed(df, names).select(*names)


def carry(df: DataFrame, used: list[str], results: list[str], body: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``body`` on a frame whose columns other than ``used`` bear names that clash with nothing.

    The result has the columns of ``df`` in order, less those named like one of ``results``,
    and then ``results``.  Columns of ``used`` that ``df`` lacks are no concern of it.
    """
    plain = _renamed(df, used)
    clash = {r.lower() for r in results}
    kept = [(new, old) for new, old in zip(plain.columns, df.columns) if old.lower() not in clash]
    out = body(plain).select(*[new for new, _ in kept], *results)
    return out.toDF(*[old for _, old in kept], *results)


def _renamed(df: DataFrame, used) -> DataFrame:
    first = {name: df.columns.index(name) for name in used if name in df.columns}
    return df.toDF(*[c if first.get(c) == i else f"__other{i}" for i, c in enumerate(df.columns)])
