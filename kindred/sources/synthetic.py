"""Synthetic profiles for scale tests.

All randomness is a hash of the row key, the field and a seed, so a retried or
repartitioned task draws the same values again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import constants as K


def uniform(key: Column, field: str, seed: int) -> Column:
    """Number in (0, 1) fixed by key, field and seed."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"/{field}/{seed}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def normal(key: Column, field: str, seed: int) -> Column:
    """Standard normal number from two uniform ones."""
    radius = F.sqrt(-2.0 * F.log(uniform(key, field + "/r", seed)))
    return radius * F.cos(2.0 * 3.141592653589793 * uniform(key, field + "/a", seed))


def _by_position(values: dict[str, float], default: float) -> Column:
    out = F
    for code, value in values.items():
        out = out.when(F.col("pos") == code, value)
    return out.otherwise(default)


def synthesise(names: DataFrame, seed: int = 42, key: str = "row_id", flagged_names: list[str] | None = None) -> DataFrame:
    """Statistics, minutes, value and flag for ``names(row_id, player, pos, age, nation, is_elite)``.

    The flag goes to listed names and to everyone of a listed nation.
    """
    k = F.col(key)
    factor = F.when(F.col("is_elite"), K.ELITE_FACTOR).otherwise(1.0)
    fields = {}
    for stat, spread in K.SYNTHETIC_SPREAD.items():
        mean = _by_position({code: means[stat] for code, means in K.SYNTHETIC_MEANS.items()}, 0.0)
        if stat == "pass_completion_pct":
            fields[stat] = F.round(F.least(F.lit(98.0), F.greatest(F.lit(45.0), mean + spread * normal(k, stat, seed))), 1)
        else:
            fields[stat] = F.greatest(F.lit(0.0), F.round(mean * factor + spread * normal(k, stat, seed), 3))
    peak = F.greatest(F.lit(0.25), 1.2 - F.greatest(F.lit(0), F.col("age") - 25) * 0.07)
    base = _by_position(K.SYNTHETIC_BASE_VALUE, 10e6)
    value = F.round(base * peak * (0.4 + 1.8 * uniform(k, "value", seed)), -4)
    return names.withColumns(
        {
            **fields,
            "playing_time_min": F.floor(900 + 2400 * uniform(k, "minutes", seed)).cast("int"),
            "market_value_eur": value,
            "market_value_raw": F.format_string("€%.1fM", value / 1e6),
            "contract_expires": F.concat(F.lit("202"), F.floor(5 + 4 * uniform(k, "contract", seed)).cast("string")),
            "is_world_cup": F.when(F.col("nation").isin(K.FLAGGED_NATIONS) | F.col("player").isin(flagged_names or []), 1).otherwise(0),
        }
    )
