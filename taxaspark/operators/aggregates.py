"""Grouped and whole-table aggregates (all partial + final in Spark)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import share_true


def group_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """``count(k, name = name)``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def group_count_having(df: DataFrame, keys: Sequence[str], keep, name: str = "n") -> DataFrame:
    """``group_by(k) %>% count() %>% filter(pred(n))``; ``keep`` maps the count column to a condition."""
    out = group_count(df, keys, name)
    return out.filter(keep(F.col(name)))


def group_share(df: DataFrame, keys: Sequence[str], cond: Column, name: str) -> DataFrame:
    """``summarize(p = mean(cond, na.rm = TRUE))`` with no value giving 0."""
    return df.groupBy(*keys).agg(share_true(cond).alias(name))


def count_false(df: DataFrame, flags: Mapping[str, str | Column]) -> DataFrame:
    """One row: for each named flag, the number of rows where it is FALSE (NULL not counted)."""
    aggs = []
    for name, c in flags.items():
        col = F.col(c) if isinstance(c, str) else c
        aggs.append(F.count_if(~col).alias(name))
    return df.agg(*aggs)


def wide_to_long(df: DataFrame, names: Sequence[str], name_col: str, value_col: str,
                 ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot the named columns into (name, value) rows."""
    return df.unpivot(list(ids), list(names), name_col, value_col)


def flag_summary(df: DataFrame, flags: Mapping[str, str | Column],
                 step_col: str = "cleaning_step", count_col: str = "records_cleaned") -> DataFrame:
    """Rows flagged FALSE per cleaning step, as a long table (one pass over ``df``)."""
    return wide_to_long(count_false(df, flags), list(flags), step_col, count_col)
