"""Resumable enrichment: usable addresses, first usable candidate, pending rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.constants import MISSING_INDEX, SEARCH_DENY
from kindred.functions.text import needs_value, usable_url


def first_candidate(candidates: DataFrame, key: str, url: str, index: str, deny: list[str] = SEARCH_DENY) -> DataFrame:
    """Per key the usable address with the smallest relevance index; a missing index counts last."""
    order = F.struct(F.coalesce(F.col(index), F.lit(MISSING_INDEX)), F.col(url))
    usable = candidates.where((F.col(url) != "") & ~denied(F.col(url), deny))
    return usable.groupBy(key).agg(F.min_by(url, order).alias(url))


def denied(url: Column, deny: list[str]) -> Column:
    """Address holds one of the deny words, in any case."""
    return ~usable_url(F.concat(F.lit("http"), url), deny)


def map_by_name(base: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """Set ``column`` of every base row from ``values(key, column)``; no value gives NULL."""
    return base.drop(column).join(values.select(key, column), key, "left")


def pending_rows(base: DataFrame, column: str, key: str = "player", force: bool = False) -> DataFrame:
    """Rows that still lack a usable value; all named rows with ``force``."""
    named = base.where(F.col(key).isNotNull())
    return named if force else named.where(needs_value(F.col(column)))


def not_done(base: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``base`` without an entry in the finished table."""
    return base.join(done.select(*keys), keys, "left_anti")


def enrich(base: DataFrame, column: str, resolve: Callable[[DataFrame], DataFrame], key: str = "player", force: bool = False) -> DataFrame:
    """Fill ``column`` for pending rows only.

    ``resolve(names)`` returns ``(key, column)`` for the names it could
    settle; rows outside the pending set keep their value.
    """
    pending = pending_rows(base, column, key, force).select(key).distinct()
    fresh = resolve(pending).select(key, F.col(column).alias("_fresh"))
    settled = pending.join(fresh, key, "left").withColumn("_pending", F.lit(True))
    out = base.join(settled, key, "left")
    return out.withColumn(column, F.when(F.col("_pending"), F.col("_fresh")).otherwise(F.col(column))).drop("_fresh", "_pending")
