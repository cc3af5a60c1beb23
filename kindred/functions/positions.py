"""Position containment and position groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from kindred.functions.constants import BROAD_POSITIONS, EVALUATION_GROUPS


def contains_code(pos: Column, code: Column | str) -> Column:
    """Case-insensitive containment; a missing position never matches."""
    code = F.lit(code) if isinstance(code, str) else code
    return F.coalesce(F.contains(F.upper(pos), F.upper(code)), F.lit(False))


def _any_code(pos: Column, codes: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [contains_code(pos, c) for c in codes])


def broad_group(pos: Column, rules: list[tuple[str, list[str]]] = BROAD_POSITIONS) -> Column:
    """First rule with a contained code wins; ``UNK`` when none does."""
    branches = reduce(lambda acc, r: acc.when(_any_code(pos, r[1]), r[0]), rules, F)
    return branches.otherwise(F.lit("UNK"))


def evaluation_group(pos: Column, rules: list[tuple[str, list[str]]] = EVALUATION_GROUPS) -> Column:
    """Last rule with a contained code wins; NULL when none does."""
    return reduce(lambda acc, r: acc.when(_any_code(pos, r[1]), r[0]), reversed(rules), F)


def squad_prefix(pos: Column) -> Column:
    """Two-letter upper-case prefix used for averages of incomplete rows."""
    return F.upper(F.substring(pos, 1, 2))
