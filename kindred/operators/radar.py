"""Radar payload: each profile against its position group, scaled by the 95th percentile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.columns import as_double, present_columns, quoted
from kindred.functions.constants import BROAD_POSITIONS, RADAR_FEATURES
from kindred.functions.positions import broad_group
from kindred.functions.text import feature_label
from kindred.operators.quantiles import exact_quantiles


def scaled_by(value: Column, top: Column) -> Column:
    """``min(value / top, 1)``; 0 when ``top`` is missing or 0; a missing value stays missing."""
    return F.when(top.isNull() | (top == 0), 0.0).when(value.isNotNull(), F.least(value / top, F.lit(1.0)))


def group_averages(df: DataFrame, features: list[str], rules=BROAD_POSITIONS) -> DataFrame:
    """One row per broad group: mean of every feature as an array in feature order."""
    means = [F.avg(as_double(quoted(f))) for f in features]
    grouped = df.groupBy(broad_group(F.coalesce("pos", F.lit("")), rules).alias("pos_group"))
    return grouped.agg(F.array(*means).alias("averages"))


def top_values(df: DataFrame, features: list[str], prob: float = 0.95) -> DataFrame:
    """One row: the quantile of every feature as a map."""
    q = exact_quantiles(df, features, [prob])
    return q.agg(F.map_from_entries(F.collect_list(F.struct("feature", "quantile"))).alias("tops"))


def radar_profiles(df: DataFrame, features: list[str] | None = None, position_avg: bool = True, rules=BROAD_POSITIONS) -> DataFrame:
    """``(row_id, player, radar)`` for all profiles in one plan.

    ``radar`` is an array of ``feature, label, value, average, raw``.  The
    group means with the quantiles (at most one row per rule) are broadcast.
    """
    features = features or present_columns(df, RADAR_FEATURES)
    if not features:
        raise ValueError("no radar features in the frame")
    grouped = df.withColumn("pos_group", broad_group(F.coalesce("pos", F.lit("")), rules))
    reference = group_averages(df, features, rules).withColumn("tops", top_values(df, features).scalar())
    joined = grouped.join(F.broadcast(reference), "pos_group")
    cells = []
    for i, f in enumerate(features):
        top = F.try_element_at("tops", F.lit(f))
        average = F.get("averages", F.lit(i)) if position_avg else F.lit(0.0)
        raw = as_double(quoted(f))
        cells.append(
            F.struct(
                F.lit(f).alias("feature"), feature_label(F.lit(f)).alias("label"), scaled_by(raw, top).alias("value"),
                scaled_by(average, top).alias("average"), raw.alias("raw"),
            )
        )
    return joined.select("row_id", "player", "pos_group", F.array(*cells).alias("radar"))
