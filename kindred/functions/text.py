"""Text scalars: names, money, addresses, labels, profile sentences."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions import constants as K
from kindred.functions.columns import as_double, detect_col, literal_map, lookup, present_columns, quoted

# ---------------------------------------------------------------- normalisers


def _fold(text: str | None, compatible: bool) -> str:
    """Lower-case without marks: combining signs, or non-spacing marks only."""
    if text is None:
        return ""
    if text.isascii():
        return text.lower()
    plain = unicodedata.normalize("NFKD" if compatible else "NFD", text)
    for sign in set(plain):
        if unicodedata.combining(sign) if compatible else unicodedata.category(sign) == "Mn":
            plain = plain.replace(sign, "")
    return plain.lower()


#: Texts folded together; long ones are never all Python strings at once.
FOLDED_ROWS = 128


def _each(texts: pa.Array, fold: Callable[[str | None], str]) -> pa.Array:
    """``fold`` of every text, some rows at a time."""
    parts = [texts.slice(i, FOLDED_ROWS) for i in range(0, len(texts), FOLDED_ROWS)]
    return pa.concat_arrays([pa.array(map(fold, part.to_pylist()), pa.string()) for part in parts] or [pa.array([], pa.string())])


@F.arrow_udf(T.StringType())
def fold_name(names: pa.Array) -> pa.Array:
    """Drop diacritics (canonical decomposition), lower-case, trim; missing text is ''."""
    return _each(names, lambda x: _fold(x, False).strip())


@F.arrow_udf(T.StringType())
def _fold_marks(names: pa.Array) -> pa.Array:
    return _each(names, lambda x: _fold(x, True))


def fold_plain(name: Column) -> Column:
    """Diacritics dropped (compatibility form) and all but ``a-z0-9`` and space blanked."""
    return F.trim(F.regexp_replace(_fold_marks(name), "[^a-z0-9 ]", " "))


def match_key(player: Column, club: Column) -> Column:
    """``player | club`` from two folded names."""
    return F.concat_ws(" | ", player, club)


def sorted_tokens(text: Column) -> Column:
    """Whitespace tokens in code-point order, joined by one space."""
    return F.array_join(F.array_sort(F.split(F.trim(text), r"\s+")), " ")


# -------------------------------------------------------------- name variants


def search_variants(name: Column, plain: Column) -> Column:
    """Ordered search spellings of a name, without case-insensitive repeats.

    ``plain`` is the ``fold_plain`` form, computed in an earlier step: Spark
    allows no Python kernel inside a higher-order function.
    """
    full = F.trim(name)
    parts = F.split(full, r"\s+")
    first, last = F.element_at(parts, 1), F.element_at(parts, -1)
    several = F.size(parts) >= 2
    suffixless = F.trim(F.regexp_replace(full, r"(?i)\s+(Jr\.?|Sr\.?|II|III|IV)$", ""))
    raw = F.array(
        full,
        F.when(several, last),
        F.when(several, first),
        F.when(several, F.concat_ws(" ", first, last)),
        F.when(several & (plain != F.lower(full)), plain),
        F.when(suffixless != full, suffixless),
    )
    kept = F.filter(raw, lambda x: x.isNotNull() & (F.trim(x) != ""))
    lowered = F.transform(kept, lambda x: F.lower(x))
    return F.filter(kept, lambda x, i: F.array_position(lowered, F.lower(x)) == i + 1)


def token_name_score(search_plain: Column, candidate_plain: Column) -> Column:
    """Token Jaccard of two plain-folded names with floors.

    Equal names score 1, containment at least .75, an equal last token at
    least .70.
    """
    s_parts = F.filter(F.split(search_plain, " +"), lambda x: x != "")
    c_parts = F.filter(F.split(candidate_plain, " +"), lambda x: x != "")
    jaccard = F.size(F.array_intersect(s_parts, c_parts)) / F.size(F.array_union(s_parts, c_parts))
    contained = F.contains(candidate_plain, search_plain) | F.contains(search_plain, candidate_plain)
    same_last = F.try_element_at(s_parts, F.lit(-1)) == F.try_element_at(c_parts, F.lit(-1))
    return (
        F.when(search_plain == candidate_plain, 1.0)
        .when((F.size(s_parts) == 0) | (F.size(c_parts) == 0), 0.0)
        .otherwise(F.greatest(jaccard, F.when(contained, 0.75), F.when(same_last, 0.70)))
    )


# ----------------------------------------------------------------------- money


def parse_money(text: Column) -> Column:
    """``€85m``, ``€850k``, ``€1.2bn`` to a number; anything unreadable is NULL."""
    body = F.lower(F.trim(F.replace(F.replace(text, F.lit("€"), F.lit("")), F.lit(","), F.lit("."))))
    unit = (
        F.when(F.contains(body, F.lit("bn")), 1e9)
        .when(F.contains(body, F.lit("m")), 1e6)
        .when(F.contains(body, F.lit("k")), 1e3)
        .otherwise(1.0)
    )
    number = F.regexp_replace(body, r"[^0-9.]", "").try_cast("double")
    return F.when(~text.isin("", "-", "?"), number * unit)


def format_money(value: Column) -> Column:
    """``€x.xM``, ``€xK``, ``€x`` or ``N/A``; half-even at the last digit shown."""
    millions = F.format_string("€%.1fM", F.bround(value / 1e6, 1))
    thousands = F.format_string("€%.0fK", F.bround(value / 1e3, 0))
    units = F.concat(F.lit("€"), F.format_number(F.bround(value, 0), 0))
    return (
        F.when(value.isNull() | F.isnan(value), "N/A")
        .when(value >= 1e6, millions)
        .when(value >= 1e3, thousands)
        .otherwise(units)
    )


# ------------------------------------------------------------------- addresses


def usable_url(url: Column, deny: list[str] = K.DISPLAY_DENY) -> Column:
    """Starts with http and holds none of the deny words (any case)."""
    pattern = "|".join(re.escape(w.lower()) for w in deny)
    good = F.startswith(F.trim(url), F.lit("http")) & ~F.rlike(F.lower(url), F.lit(pattern))
    return F.coalesce(good, F.lit(False))


def needs_value(url: Column) -> Column:
    """Value missing or no http address."""
    return url.isNull() | ~F.startswith(url, F.lit("http"))


def slug(name: Column) -> Column:
    safe = F.regexp_replace(name, "[^a-zA-Z0-9_-]", "_")
    return F.lower(F.btrim(F.regexp_replace(safe, "_+", "_"), F.lit("_")))


def cache_key(url: Column) -> Column:
    return F.substring(F.md5(url), 1, 12)


def image_extension(url: Column) -> Column:
    """Extension of the path part, from a fixed allow list, else jpg."""
    path = F.split_part(url, F.lit("?"), F.lit(1))
    ext = F.lower(F.regexp_extract(path, r"\.([^.]*)$", 1))
    return F.when(ext.isin(K.IMAGE_EXTENSIONS), ext).otherwise("jpg")


def first_usable(*candidates: tuple[Column, Column]) -> Column:
    """Value of the first ``(value, usable)`` pair whose test holds."""
    return F.coalesce(*[F.when(ok, value) for value, ok in candidates])


def best_image(df: DataFrame) -> Column:
    """Search-service address, else a usable encyclopaedia address, else the local path."""
    def col(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    service, wiki, local = col("sportsdb_image_url"), col("image_url"), col("local_image_path")
    return first_usable(
        (F.trim(service), F.startswith(F.trim(service), F.lit("http"))),
        (F.trim(wiki), usable_url(wiki)),
        (F.concat(F.lit("/"), F.trim(local)), usable_url(wiki) & (F.trim(local) != "")),
    )


# ------------------------------------------------------------ labels and codes


def strip_markers(text: Column) -> Column:
    """Remove ``(…)`` and ``[…]`` with the blanks around them."""
    plain = F.trim(F.regexp_replace(text, r"\s*\([^)]*\)\s*", ""))
    return F.trim(F.regexp_replace(plain, r"\s*\[[^\]]*\]\s*", ""))


def feature_label(name: Column) -> Column:
    derived = F.initcap(F.replace(F.replace(name, F.lit("_per90"), F.lit("/90")), F.lit("_"), F.lit(" ")))
    return F.coalesce(lookup(K.FEATURE_LABELS, name), derived)


def similarity_band(score: Column, cuts: tuple[float, float] = (0.82, 0.65)) -> Column:
    """``high`` / ``medium`` / ``low``; both cuts inclusive."""
    return F.when(score >= cuts[0], "high").when(score >= cuts[1], "medium").otherwise("low")


def bar_band(score: Column, cuts: tuple[float, float] = (0.8, 0.6)) -> Column:
    """Banding of the similarity bar; both cuts exclusive."""
    return F.when(score > cuts[0], "high").when(score > cuts[1], "medium").otherwise("low")


def country_code(name: Column) -> Column:
    return lookup(K.COUNTRY_CODES, name)


def squad_position(raw: Column) -> Column:
    return lookup(K.SQUAD_POSITIONS, raw)


def nation_text(df: DataFrame) -> Column:
    """First non-blank nation column; '' when there is none."""
    names = present_columns(df, ["nation", "nationality_tm", "nationality"])
    usable = [F.when(~F.trim(F.col(c)).isin("", "N/A", "nan"), F.trim(F.col(c))) for c in names]
    return F.coalesce(*usable, F.lit(""))


def nation_label(code: Column) -> Column:
    return F.coalesce(lookup(K.NATION_LABELS, F.upper(code)), code)


def flag_key(code: Column) -> Column:
    """Flag key of a nation code, ``un`` when unknown, '' when there is no code."""
    trimmed = F.trim(code)
    empty = trimmed.isNull() | trimmed.isin("", "N/A", "nan", "None", "-")
    return F.when(empty, "").otherwise(F.coalesce(lookup(K.FLAG_KEYS, F.upper(trimmed)), F.lit(K.UNKNOWN_FLAG)))


def label_to_code(label: Column) -> Column:
    """Country label (flag signs allowed) or code to an upper-case code."""
    by_label = {v: k for k, v in K.NATION_LABELS.items()}
    plain = F.trim(F.regexp_replace(label, r"[^\p{L}\p{M}\p{Zs}&'.-]", ""))
    return F.upper(F.coalesce(F.try_element_at(literal_map(by_label), plain), label))


# ------------------------------------------------------------- profile sentence


def profile_sentence(df: DataFrame) -> Column:
    """Natural-language profile of a row, with neutral defaults."""

    def text(name: str, default: str) -> Column:
        if name not in df.columns:
            return F.lit(default)
        return F.coalesce(F.col(name).cast("string"), F.lit("nan"))

    def number(*names: str, default: float = 0.0) -> Column:
        column = detect_col(df, list(names))
        return F.coalesce(as_double(quoted(column)), F.lit(default)) if column else F.lit(default)

    def two(*names: str) -> Column:
        return F.bround(number(*names), 2)

    return F.format_string(
        K.PROFILE_SENTENCE,
        text("player", "Unknown Player"),
        number("age", default=float(K.DEFAULT_AGE)).cast("int"),
        text("pos", "Unknown Position"),
        text("squad", "Unknown Club"),
        text("league", "Unknown League"),
        two("gls_per90", "gls"),
        two("ast_per90", "ast"),
        F.bround(number("pass_completion_pct", "cmp_pct"), 0),
        two("xg_per90", "xg"),
        two("tackles_tkl_per90", "tackles_tkl"),
    )


def whole_word(text: Column, phrase: str) -> Column:
    return F.rlike(text, F.lit(rf"(?U)\b{re.escape(phrase)}\b"))


def drop_phrases(text: Column, phrases: list[str], put: str = " ") -> Column:
    """Blank each whole phrase, in the order given."""
    return reduce(lambda t, p: F.regexp_replace(t, rf"(?U)\b{re.escape(p)}\b", put), phrases, text)
