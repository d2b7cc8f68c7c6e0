"""Column-set and row-set operators (projection, union, difference)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import qcol
from pyspark.sql.types import DataType, NumericType, StructField, StructType

from ..functions.numeric import round_half_up
from ..session import staged


class SchemaError(ValueError):
    """A column that an operator needs is missing, or types do not agree."""


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise SchemaError(f"unknown column(s) {missing}; frame has {df.columns}")


def drop_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``select(-c(...))``: dropping a column that does not exist is an error."""
    require_columns(df, cols)
    return df.drop(*dict.fromkeys(cols))


def keep_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    require_columns(df, cols)
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Simultaneous rename ``{old: new}``; all pairs see the input names.

    ``{'scientificName': 'NameAuthor', 'species': 'scientificName'}`` shifts
    the names in one step, independent of the order of the pairs.
    """
    require_columns(df, mapping.keys())
    return df.select(*[qcol(c).alias(mapping.get(c, c)) for c in df.columns])


def conform(df: DataFrame, template: StructType) -> DataFrame:
    """Select the template's columns in its order and types; absent ones are NULL."""
    out = []
    for f in template.fields:
        src = qcol(f.name) if f.name in df.columns else F.lit(None)
        out.append(src.cast(f.dataType).alias(f.name))
    return df.select(*out)


def map_columns(df: DataFrame, kind: type[DataType], fn: Callable[[Column], Column]) -> DataFrame:
    """``mutate_if(is.<kind>, fn)``: apply ``fn`` to every column of that type."""
    return df.select(*[
        (fn(qcol(f.name)).cast(f.dataType) if isinstance(f.dataType, kind) else qcol(f.name)).alias(f.name)
        for f in df.schema.fields
    ])


def round_numeric(df: DataFrame, digits: int = 3) -> DataFrame:
    """``mutate_if(is.numeric, round, digits)``; integers are unchanged, every column keeps its type."""
    def rnd(f: StructField) -> Column:
        kind = f.dataType.typeName()
        if kind == "decimal":
            return F.round(qcol(f.name), digits).cast(f.dataType).alias(f.name)
        if kind in ("double", "float"):
            return round_half_up(qcol(f.name), digits).cast(f.dataType).alias(f.name)
        return qcol(f.name)
    return df.select(*[rnd(f) for f in df.schema.fields])


def _check_union_types(a: DataFrame, b: DataFrame) -> None:
    ta = {f.name: f.dataType for f in a.schema.fields}
    for f in b.schema.fields:
        if f.name in ta:
            x, y = ta[f.name], f.dataType
            if x != y and not (isinstance(x, NumericType) and isinstance(y, NumericType)):
                raise SchemaError(f"column {f.name!r}: cannot bind {x.simpleString()} with {y.simpleString()}")


def union_missing(*frames: DataFrame) -> DataFrame:
    """``bind_rows``: union all by name, absent columns NULL; text never mixes with numbers."""
    out = frames[0]
    for nxt in frames[1:]:
        _check_union_types(out, nxt)
        out = out.unionByName(nxt, allowMissingColumns=True)
    return out


def union_strict(*frames: DataFrame) -> DataFrame:
    """``rbind``: union all by name; the column sets must agree."""
    out = frames[0]
    for nxt in frames[1:]:
        if set(out.columns) != set(nxt.columns):
            raise SchemaError(f"rbind needs equal column sets: {out.columns} vs {nxt.columns}")
        _check_union_types(out, nxt)
        out = out.unionByName(nxt)
    return out


#: rows of more columns than this are compared by their prints first
NARROW = 8


def row_print(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of the whole row, nulls told from values; equal rows have equal prints (so -0.0 is 0.0)."""
    cols = [(qcol(f.name) + F.lit(0.0)).cast(f.dataType) if f.dataType.typeName() in ("double", "float") else qcol(f.name)
            for f in df.schema.fields]
    marks = [qcol(c).isNull() for c in df.columns]
    return [F.xxhash64(*cols, *marks).alias("__print_a__"), F.xxhash64(F.lit(1), *marks, *cols).alias("__print_b__")]


PRINT = ["__print_a__", "__print_b__"]


def distinct_rows(df: DataFrame) -> DataFrame:
    """``distinct()``; of wide rows only those are shuffled whole whose 128-bit print occurs again.

    The prints are counted (16 bytes a row are shuffled, after a map-side count). A row whose print is its own passes where it
    lies; the others, which the prints only suspect, are compared as rows. The repeated prints are staged, so the planner
    broadcasts them where their real size allows and shuffles the join otherwise. ``df`` is read twice and has to give the same rows each time.
    """
    if len(df.columns) <= NARROW:
        return df.distinct()
    keyed = df.select("*", *row_print(df))
    again = staged(keyed.groupBy(*PRINT).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*PRINT), "prints")
    alone = keyed.join(again, PRINT, "left_anti").drop(*PRINT)
    return alone.unionByName(keyed.join(again, PRINT, "left_semi").drop(*PRINT).distinct())


def union_distinct(*frames: DataFrame) -> DataFrame:
    """``distinct(rbind(a, b))``."""
    return distinct_rows(union_strict(*frames))


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """``setdiff(a, b)``: distinct rows of ``a`` that are not rows of ``b``.

    Wide rows as in ``distinct_rows``: a row of ``a`` whose print ``a`` holds once and ``b`` never passes; the others
    meet those of ``b`` with the same prints, as rows.
    """
    b = b.select(*[qcol(c) for c in a.columns])
    if len(a.columns) <= NARROW or [f.dataType for f in a.schema.fields] != [f.dataType for f in b.schema.fields]:
        return a.subtract(b)                 # prints of unlike types would not agree
    mine, other = a.select("*", *row_print(a)), b.select("*", *row_print(b))
    sides = mine.select(*PRINT, F.lit(0).alias("other")).unionByName(other.select(*PRINT, F.lit(1).alias("other")))
    told = sides.groupBy(*PRINT).agg(F.count(F.lit(1)).alias("n"), F.min("other").alias("low"))
    doubt = staged(told.where("n > 1 AND low = 0").select(*PRINT), "prints")
    alone = mine.join(doubt, PRINT, "left_anti").drop(*PRINT)
    met = mine.join(doubt, PRINT, "left_semi").drop(*PRINT).subtract(other.join(doubt, PRINT, "left_semi").drop(*PRINT))
    return alone.unionByName(met)


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``drop_na(cols)`` / ``drop_na()``."""
    if cols:
        require_columns(df, cols)
        return df.na.drop(how="any", subset=list(cols))
    return df.na.drop(how="any")


def split_by_null(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Rows where ``col`` is present, and rows where it is NULL."""
    return df.filter(qcol(col).isNotNull()), df.filter(qcol(col).isNull())
