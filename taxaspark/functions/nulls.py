"""R-style NULL rules as Spark column expressions.

Plain Spark and the reference disagree on NULLs in a few places (membership
tests, regex tests, ``ifelse`` and ``paste``). Each helper names the rule it
keeps so that a call site states its choice.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def qcol(name: str) -> Column:
    """Column by its exact name (dots and blanks are part of the name, not a path)."""
    return F.col("`" + name.replace("`", "``") + "`")


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_member(c: str | Column, values: Iterable) -> Column:
    """``x %in% c(...)``: never NULL; NULL is a member only if ``None`` is listed."""
    vals = list(values)
    plain = [v for v in vals if v is not None]
    x = col_of(c)
    # ``x IS NOT NULL AND x IN (...)`` is never NULL and, unlike ``coalesce``, reaches the scan
    hit = (x.isNotNull() & x.isin(plain)) if plain else F.lit(False)
    return (hit | x.isNull()) if len(plain) != len(vals) else hit


def not_member(c: str | Column, values: Iterable) -> Column:
    """``!(x %in% c(...))``: a NULL value is kept unless ``None`` is listed."""
    return ~is_member(c, values)


def matches(c: str | Column, pattern: str) -> Column:
    """``grepl(pattern, x)``: a NULL value does not match."""
    return F.coalesce(col_of(c).rlike(pattern), F.lit(False))


def not_matches(c: str | Column, pattern: str) -> Column:
    """``!grepl(pattern, x)``: a NULL value is kept."""
    return ~matches(c, pattern)


def ifelse(cond: Column, yes, no) -> Column:
    """R ``ifelse``: a NULL condition gives NULL, not the ``no`` branch."""
    yes_c = yes if isinstance(yes, Column) else F.lit(yes)
    no_c = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes_c).when(~cond, no_c)


def na_text(c: str | Column) -> Column:
    """Text of a value as R prints it in ``paste``: NULL becomes ``NA``."""
    return F.coalesce(col_of(c).cast("string"), F.lit("NA"))


def paste(*cols: str | Column, sep: str = " ") -> Column:
    """R ``paste``: values joined by ``sep``; a NULL value is written ``NA``."""
    return F.concat_ws(sep, *[na_text(c) for c in cols])


def paste0(*cols: str | Column) -> Column:
    return paste(*cols, sep="")


def paste_guarded(name: str | Column, author: str | Column) -> Column:
    """Name alone when the author is missing, else ``paste(name, author)``."""
    a = col_of(author)
    return F.when(a.isNull(), col_of(name)).otherwise(paste(name, author))


def blank_to_null(c: str | Column) -> Column:
    """``''`` and NULL are both missing."""
    return F.nullif(col_of(c), F.lit(""))


def present(c: str | Column) -> Column:
    """Present and non-blank: ``x != '' & !is.na(x)``."""
    x = col_of(c)
    return x.isNotNull() & (x != F.lit(""))


def all_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def any_of(conds: Iterable[Column]) -> Column:
    conds = list(conds)
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)
