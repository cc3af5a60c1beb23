"""Cleaning, deduplication, data-quality checks and exploratory statistics."""

from __future__ import annotations

from itertools import combinations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.columns import as_double, detect_col, present_columns, quoted
from kindred.functions.constants import BOUNDS, COUNTING_STATS, MIN_MINUTES
from kindred.operators.quantiles import exact_quantiles

MINUTES_COLUMNS = ["playing_time_min", "min", "minutes", "playing_time_minutes"]
NAME_COLUMNS = ["player", "name"]

# ------------------------------------------------------------------- cleaning


def minimum_exposure(df: DataFrame, minutes: str, threshold: float = MIN_MINUTES) -> DataFrame:
    """Rows with at least ``threshold`` minutes; unreadable minutes are dropped."""
    return df.withColumn(minutes, as_double(quoted(minutes))).where(F.col(quoted(minutes)) >= threshold)


def per90_rates(df: DataFrame, minutes: str, stats: list[str] = COUNTING_STATS) -> DataFrame:
    """Add ``<stat>_per90`` with four decimals for every counting statistic present."""
    present = present_columns(df, stats)
    numbers = df.withColumns({s: as_double(quoted(s)) for s in present})
    per90 = F.col(quoted(minutes)) / 90.0
    return numbers.withColumns({f"{s}_per90": F.bround(F.col(quoted(s)) / per90, 4) for s in present})


def _one_per_key(df: DataFrame, keys: list[str], best: Column, largest: bool) -> DataFrame:
    """One whole row per key by an aggregate, so a hot key is combined map-side."""
    row = F.struct(*[F.col(quoted(c)) for c in df.columns])
    pick = F.max_by(row, best) if largest else F.min_by(row, best)
    return df.groupBy(*[F.col(quoted(k)).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(pick.alias("row")).select("row.*")


def keep_max(df: DataFrame, keys: list[str], by: str, order: str = "row_id") -> DataFrame:
    """Row with the largest ``by`` per key; equal values go to the earlier row, NULL last."""
    value = F.coalesce(as_double(quoted(by)), F.lit(float("-inf")))
    return _one_per_key(df, keys, F.struct(value, -F.col(order)), True)


def keep_first(df: DataFrame, keys: list[str], order: str = "row_id") -> DataFrame:
    return _one_per_key(df, keys, F.col(order), False)


def clean_statistics(df: DataFrame, order: str = "row_id", threshold: float = MIN_MINUTES) -> DataFrame:
    """Threshold, transfer deduplication and per-90 rates of a raw statistics table.

    A name seen in several leagues keeps its row with most minutes.  Picking
    per league first and then overall gives the same row, so one pass is used.
    """
    minutes = detect_col(df, MINUTES_COLUMNS)
    if minutes is None:
        return df
    played = minimum_exposure(df, minutes, threshold)
    names = present_columns(df, NAME_COLUMNS)
    return per90_rates(keep_max(played, names, minutes, order) if names else played, minutes)


# ------------------------------------------------------------- quality reports


def _as_rows(df: DataFrame, names: list[str], key: str, **fields) -> DataFrame:
    """Turn one row of per-column aggregates into one row per column."""
    cells = [
        F.struct(F.lit(n).alias(key), *[F.col(quoted(f"{f}_{n}")).alias(f) for f in fields]) for n in names
    ]
    return df.select(F.inline(F.array(*cells)))


def missing_rates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, missing_pct)`` of every column, from one aggregation."""
    columns = columns or df.columns
    share = {c: F.avg(F.when(F.col(quoted(c)).isNull(), 100.0).otherwise(0.0)).alias(f"missing_pct_{c}") for c in columns}
    return _as_rows(df.agg(*share.values()), columns, "column_name", missing_pct=None)


def highly_missing(rates: DataFrame, limit: float = 20.0) -> DataFrame:
    return rates.where(F.col("missing_pct") > limit).orderBy(F.desc("missing_pct"), "column_name")


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of rows, in percent, that hold a value; per column."""
    share = [F.avg(F.when(F.col(quoted(c)).isNotNull(), 100.0).otherwise(0.0)).alias(f"coverage_pct_{c}") for c in columns]
    return _as_rows(df.agg(*share), columns, "column_name", coverage_pct=None)


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every member of a key group with more than one row.

    Missing keys are equal to each other.  Groups are counted with map-side combine; the join back is a left-semi
    join whose row side Spark may split when one key is hot.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    repeated = repeated.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return df.join(repeated, reduce(lambda a, b: a & b, same), "left_semi")


def bounds_violations(df: DataFrame, bounds: dict[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    """``(column_name, violations)``; a missing value violates nothing."""
    rules = {c: b for c, b in bounds.items() if c in df.columns}
    outside = []
    for c, (low, high) in rules.items():
        v = as_double(quoted(c))
        outside.append(F.count_if((v < low) | (v > high)).alias(f"violations_{c}"))
    return _as_rows(df.agg(*outside), list(rules), "column_name", violations=None)


def iqr_outliers(df: DataFrame, columns: list[str], factor: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values outside them, per column."""
    q = exact_quantiles(df, columns, [0.25, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("quantile"))).alias("q3"),
    )
    fences = q.withColumns(
        {
            "lower_fence": F.col("q1") - factor * (F.col("q3") - F.col("q1")),
            "upper_fence": F.col("q3") + factor * (F.col("q3") - F.col("q1")),
        }
    )
    named = [F.struct(F.lit(c).alias("feature"), as_double(quoted(c)).alias("value")) for c in columns]
    values = df.select(F.inline(F.array(*named)))
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    counted = values.join(F.broadcast(fences), "feature").groupBy("feature").agg(F.count_if(outside).alias("outliers"))
    return fences.join(counted, "feature")


# ------------------------------------------------------------ exploratory views


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(x, y, corr)`` for all ordered pairs from one aggregation; null pairs are skipped."""
    numbers = df.select(*[as_double(quoted(c)).alias(c) for c in columns])
    pairs = list(combinations(columns, 2))
    own = [F.when(F.stddev_pop(F.col(quoted(c))) > 0, 1.0).alias(f"{c}|{c}") for c in columns]
    cross = [F.corr(F.col(quoted(a)), F.col(quoted(b))).alias(f"{a}|{b}") for a, b in pairs]
    both = [(c, c, f"{c}|{c}") for c in columns] + [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs]
    cells = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(quoted(n)).alias("corr")) for a, b, n in both]
    return numbers.agg(*own, *cross).select(F.inline(F.array(*cells)))


def ols_by_group(df: DataFrame, group: str, y: str, x: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group."""
    yc, xc = as_double(quoted(y)), as_double(quoted(x))
    return df.groupBy(group).agg(
        F.regr_slope(yc, xc).alias("slope"),
        F.regr_intercept(yc, xc).alias("intercept"),
        F.regr_r2(yc, xc).alias("r2"),
        F.regr_count(yc, xc).alias("n"),
    )


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """``(column_name, n_distinct)``; the approximate form is one cheap pass."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _as_rows(
        df.agg(*[count(F.col(quoted(c))).alias(f"n_distinct_{c}") for c in columns]), columns, "column_name", n_distinct=None
    )


def log_histogram(df: DataFrame, value: str, group: str, bins: int = 50) -> DataFrame:
    """Counts per group and equal-width bin of log10(value); the top edge joins the last bin.

    The range comes from a one-row aggregate used as a scalar subquery.
    """
    v = as_double(quoted(value))
    logs = df.where(v > 0).select(group, F.log10(v).alias("lg"))
    edges = logs.agg(F.struct(F.min("lg").alias("lo"), F.max("lg").alias("hi")).alias("e")).scalar()
    width = (edges["hi"] - edges["lo"]) / bins
    bin_no = F.when(width > 0, F.least(F.floor((F.col("lg") - edges["lo"]) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return logs.select(group, bin_no.cast("int").alias("bin")).groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"))
