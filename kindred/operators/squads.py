"""Squad lists appended to a profile table, incomplete rows imputed from averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.columns import as_double, quoted
from kindred.functions.constants import IMPUTE_SCALE, IMPUTE_UNSCALED, IMPUTED_COLUMNS, SQUAD_PREFIXES
from kindred.functions.positions import squad_prefix
from kindred.operators.quality import keep_first


def name_key(name: Column) -> Column:
    return F.lower(F.trim(name))


def position_averages(df: DataFrame, columns: list[str] = IMPUTED_COLUMNS) -> DataFrame:
    """Means per position prefix; a column the frame lacks averages to 0.  At most four rows."""
    means = [(F.avg(as_double(quoted(c))) if c in df.columns else F.lit(0.0)).alias(c) for c in columns]
    return df.where(squad_prefix(F.col("pos")).isin(SQUAD_PREFIXES)).groupBy(squad_prefix(F.col("pos")).alias("prefix")).agg(*means)


def flag_listed(existing: DataFrame, squad: DataFrame, flag: str = "is_world_cup") -> DataFrame:
    """Set the flag to 1 for rows whose name is on a squad list."""
    listed = squad.select(name_key(F.col("player")).alias("_key")).distinct().withColumn("_listed", F.lit(True))
    old = F.col(flag) if flag in existing.columns else F.lit(None).cast("int")
    out = existing.withColumn("_key", name_key(F.col("player"))).join(listed, "_key", "left")
    return out.withColumn(flag, F.when(F.col("_listed"), 1).otherwise(old)).drop("_key", "_listed")


def new_squad_rows(existing: DataFrame, squad: DataFrame, order: str = "row_id") -> DataFrame:
    """Squad rows whose name is not present yet; the first of equal names is kept."""
    known = existing.select(name_key(F.col("player")).alias("_key")).distinct()
    fresh = squad.withColumn("_key", name_key(F.col("player"))).join(known, "_key", "left_anti")
    return keep_first(fresh, ["_key"], order).drop("_key")


def impute_rows(rows: DataFrame, averages: DataFrame, columns: list[str] = IMPUTED_COLUMNS) -> DataFrame:
    """Fill statistics with 0.7 x the position mean (pass rate unscaled); unknown positions use MF."""
    prefix = squad_prefix(F.col("pos"))
    keyed = rows.withColumn("prefix", F.when(prefix.isin(SQUAD_PREFIXES), prefix).otherwise("MF"))
    scaled = averages.select(
        "prefix", *[(F.col(c) * (1.0 if c == IMPUTE_UNSCALED else IMPUTE_SCALE)).alias(c) for c in columns]
    )
    filled = keyed.drop(*columns).join(F.broadcast(scaled), "prefix", "left").drop("prefix")
    return filled.withColumns(
        {"league": F.lit(""), "is_world_cup": F.lit(1), "match_strategy": F.lit("wc2026_wiki")}
    )


def append_squads(existing: DataFrame, squad: DataFrame, order: str = "row_id") -> DataFrame:
    """Existing rows with updated flags plus imputed new rows, one row per exact name.

    ``order`` numbers the rows of each input; existing rows come first.
    """
    added = impute_rows(new_squad_rows(existing, squad, order), position_averages(existing))
    flagged = flag_listed(existing, squad).withColumn("_source", F.lit(0))
    stacked = flagged.unionByName(added.withColumn("_source", F.lit(1)), allowMissingColumns=True)
    stacked = stacked.withColumn("_order", F.struct("_source", order))
    return keep_first(stacked, ["player"], "_order").drop("_source", "_order")
