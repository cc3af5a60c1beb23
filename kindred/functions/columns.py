"""Column-role detection, name cleaning and coercion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: substring rewrites of column names, applied in this order
NAME_REWRITES = [
    ("unnamed: ", ""), ("_level_0_", "_"), ("per 90 minutes_", "per90_"),
    ("performance_", ""), ("expected_", "xg_"), ("progression_", "prog_"),
    (".", ""), (" ", "_"),
]


def detect_col(df: DataFrame, candidates: list[str]) -> str | None:
    """First of ``candidates`` that the frame has."""
    present = set(df.columns)
    return next((c for c in candidates if c in present), None)


def clean_name(name: str) -> str:
    return reduce(lambda s, rw: s.replace(*rw), NAME_REWRITES, name.lower()).strip("_")


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def quoted(name: str) -> str:
    """Name usable inside ``F.col`` and SQL text even with dots or signs in it."""
    return "`" + name.replace("`", "``") + "`"


def as_double(column: Column | str) -> Column:
    """Number or NULL: text that is no number, and NaN, become NULL."""
    column = F.col(column) if isinstance(column, str) else column
    number = column.try_cast("double")
    return F.when(~F.isnan(number), number)


def present_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Those of ``names`` the frame has, in the order given."""
    return [n for n in names if n in df.columns]


def literal_map(pairs: dict[str, str]) -> Column:
    """Small fixed lookup table as a map literal (constant-folded by Catalyst)."""
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.try_element_at(literal_map(pairs), key)
