"""Row filters over profiles and results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.columns import as_double, detect_col
from kindred.functions.text import label_to_code


def within_budget(value: Column, limit: Column | float) -> Column:
    """Value at most ``limit``; an unknown value passes."""
    return F.coalesce(as_double(value) <= limit, F.lit(True))


def value_cap(value: Column, limit: Column | float) -> Column:
    """Value at most ``limit``; an unknown value fails."""
    return F.coalesce(as_double(value) <= limit, F.lit(False))


def country_filter(df: DataFrame, selected: list[str]) -> DataFrame:
    """Rows of the selected countries, given by label or code; no selection keeps all."""
    nation = detect_col(df, ["nation", "nationality_tm"])
    if not selected or nation is None:
        return df
    return df.where(F.upper(nation).isin([label_to_code(F.lit(s)) for s in selected]))
