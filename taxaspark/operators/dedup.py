"""De-duplication with an explicit survivor rule, and group filters.

Spark keeps no row order, so "first row wins" needs an order key. Every
operator here stays safe when one key holds a large share of the rows:

* ``first_per_key`` is ``row_number() == 1``; Spark plans it with a partial
  ``WindowGroupLimit`` before the shuffle, so each map task sends at most one
  row per key.
* ``keep_unique`` counts the keys alone (partial counts before the shuffle) and
  semi-joins, not a count window that would put a hot key's rows into one task.
* ``keep_group_min`` / ``top_with_ties`` aggregate the extreme per key and
  semi-join back on (key, value), which spreads a hot key's rows over
  partitions by value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half_up
from .joins import join_on


def _cols(xs) -> list:
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """``distinct(keys, .keep_all = TRUE)``: one row per key, the first in ``order_by``."""
    order = _cols(order_by)
    if not order:
        raise ValueError("first_per_key needs an order key: Spark keeps no row order")
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("__rn__", F.row_number().over(w)).filter(F.col("__rn__") == 1).drop("__rn__")


def two_stage_dedup(df: DataFrame, keys1: Sequence[str], keys2: Sequence[str],
                    order_by: Sequence[str | Column]) -> DataFrame:
    """Two first-wins passes with the same order; the second sees the first's survivors."""
    return first_per_key(first_per_key(df, keys1, order_by), keys2, order_by)


def keep_unique(df: DataFrame, keys: Sequence[str], narrow: bool = False) -> DataFrame:
    """``group_by(k) %>% filter(n() == 1)``: rows whose key occurs exactly once.

    Keys are counted on their own (a hash aggregate with partial counts) and the rows
    of those that occur once are a semi-join: no wide row is aggregated. With ``narrow`` rows
    one aggregate carries the row itself, so that the input is read (and planned) once.
    """
    keys = _cols(keys)
    others = [c for c in df.columns if c not in keys]
    if narrow and others:
        agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n__"), F.min(F.struct(*others)).alias("__row__"))
        return agg.filter(F.col("__n__") == 1).select(*[F.col("__row__")[c].alias(c) if c in others else F.col(c)
                                                        for c in df.columns])
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n__")).filter(F.col("__n__") == 1).select(*keys)
    return join_on(df, once, keys, "left_semi", null_safe=True)


def _keep_group_extreme(df: DataFrame, keys: Sequence[str], value: str, fn) -> DataFrame:
    keys = _cols(keys)
    ext = df.groupBy(*keys).agg(fn(value).alias("__ext__"))
    on = {k: k for k in keys}
    on[value] = "__ext__"
    return join_on(df, ext, on, "left_semi", null_safe=True)


def keep_group_min(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``group_by(k) %>% filter(x == min(x, na.rm = TRUE))``: ties kept, NULL never qualifies
    (a group whose values are all NULL keeps nothing)."""
    keys = _cols(keys)
    ext = df.groupBy(*keys).agg(F.min(value).alias("__ext__"))
    on = {k: k for k in keys}
    return join_on(df, ext, on, "left_semi", null_safe=True,
                   extra=F.col(value) == F.col("__ext__"))


def top_with_ties(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``slice_max(x, n = 1)`` per key with ties; a group of only NULLs keeps all its rows."""
    return _keep_group_extreme(df, keys, value, F.max)


def grid_dedup(df: DataFrame, keys: Sequence[str], lat: str, lon: str, digits: int,
               order_by: Sequence[str | Column], keep_rounded: bool = True) -> DataFrame:
    """One record per key and coordinate cell rounded to ``digits`` decimals."""
    rl, rn = f"round_{lat}", f"round_{lon}"
    out = df.withColumn(rl, round_half_up(lat, digits)).withColumn(rn, round_half_up(lon, digits))
    out = first_per_key(out, [*_cols(keys), rl, rn], order_by)
    return out if keep_rounded else out.drop(rl, rn)
