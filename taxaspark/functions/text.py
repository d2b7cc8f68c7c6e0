"""Name and identifier functions (column expressions, no UDF)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col_of, is_member, paste0

# A word character as R's stringr (ICU) sees it: letters, marks, digits and
# the underscore. Java's ``\w`` is ASCII only, so it is spelled out.
WORD = r"[\p{L}\p{M}\p{N}_]+"

# Lookahead: a period directly followed by an upper-case letter and a
# lower-case letter gets a blank after it ("J.I.Kim" -> "J.I. Kim").
INITIAL_GAP = r"\.(?=[A-Z]\p{Ll})"


def first_word(c: str | Column) -> Column:
    """``str_extract(x, "\\w+")``: first word, NULL when there is none."""
    return F.nullif(F.regexp_extract(col_of(c), WORD, 0), F.lit(""))


def word_count(c: str | Column) -> Column:
    """``str_count(x, "\\w+")``: number of words; NULL for NULL."""
    return F.regexp_count(col_of(c), F.lit(WORD))


def binomial(c: str | Column) -> Column:
    """The first two words of a name (genus and epithet), without the author; NULL if there are fewer."""
    return F.nullif(F.regexp_extract(col_of(c), r"^\s*(\S+\s+\S+)", 1), F.lit(""))


def space_initials(c: str | Column) -> Column:
    """Put a blank after an initial's period when a name follows."""
    return F.regexp_replace(col_of(c), INITIAL_GAP, ". ")


def override(c: str | Column, fixes: Mapping[str, str], target: str | Column | None = None) -> Column:
    """Exact-value override: where ``c`` equals a key, the mapped value; else ``target``.

    ``target`` defaults to ``c`` itself. A NULL ``c`` keeps ``target``.
    """
    base = col_of(c if target is None else target)
    expr = None
    for k, v in fixes.items():
        expr = (F.when(col_of(c) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col_of(c) == F.lit(k), F.lit(v)))
    return base if expr is None else expr.otherwise(base)


def tag_id(c: str | Column, suffix: str) -> Column:
    """``paste0(id, suffix)``; a NULL id is written ``NA`` as in R."""
    return paste0(c, F.lit(suffix))


def combined_id(primary: str | Column, secondary: str | Column,
                primary_tag: str, secondary_tag: str) -> Column:
    """``ifelse(is.na(primary), paste0(secondary, s), paste0(primary, p))``."""
    return F.when(col_of(primary).isNull(), tag_id(secondary, secondary_tag)).otherwise(
        tag_id(primary, primary_tag))


def code_map(name: str | Column, groups: Mapping[str, Sequence[str]],
             existing: str | Column | None = None) -> Column:
    """Nested ``ifelse`` code map: keep an existing code, else map a name.

    ``groups`` maps a code to the names that stand for it; unknown or NULL
    names give NULL.
    """
    expr = None
    for code, names in groups.items():
        cond = is_member(name, names)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    mapped = expr if expr is not None else F.lit(None).cast("string")
    if existing is None:
        return mapped
    return F.coalesce(col_of(existing), mapped)


def lenient_double(c: str | Column) -> Column:
    """``as.numeric(x)``: text that is no number becomes NULL (never an error)."""
    return col_of(c).try_cast("double")
