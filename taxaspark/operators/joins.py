"""Joins with the reference's key rules.

dplyr joins match NULL keys to NULL keys; ``%in%`` against another table's
column is a semi or anti join that never yields NULL. Each helper takes
``null_safe`` to choose. Spark plans ``<=>`` keys as an ordinary equi-join,
so the null-safe form costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import qcol

from ..functions.nulls import all_of


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pairs(on: str | Sequence[str] | dict) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, dict):
        return list(on.items())
    return [(k, k) for k in on]


def join_on(left: DataFrame, right: DataFrame, on, how: str = "inner",
            null_safe: bool = True, extra: Column | None = None) -> DataFrame:
    """Equi-join on key pairs ``{left_key: right_key}`` (or shared names).

    One copy of each key column is kept under the left name: the left value
    for inner/left/semi/anti joins, the right value for a right join, the
    non-NULL one for a full join. Semi and anti joins return left columns.
    """
    pairs = _pairs(on)
    tmp = {rk: f"__rk{i}__" for i, (_, rk) in enumerate(pairs)}
    r = right.select(*[qcol(c).alias(tmp[c]) if c in tmp else qcol(c) for c in right.columns])
    conds = []
    for lk, rk in pairs:
        lc, rc = left[_q(lk)], r[tmp[rk]]
        conds.append(lc.eqNullSafe(rc) if null_safe else lc == rc)
    cond = all_of(conds if extra is None else conds + [extra])
    joined = left.join(r, cond, how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined
    cols = []
    rk_of = dict(pairs)
    for c in left.columns:
        if c in rk_of:
            rc = qcol(tmp[rk_of[c]])
            if how in ("right", "right_outer", "rightouter"):
                cols.append(rc.alias(c))
            elif how in ("full", "outer", "full_outer", "fullouter"):
                cols.append(F.coalesce(left[_q(c)], rc).alias(c))
            else:
                cols.append(left[_q(c)])
        else:
            cols.append(left[_q(c)])
    cols += [qcol(c) for c in r.columns if c not in tmp.values()]
    return joined.select(*cols)


def semi_join(df: DataFrame, other: DataFrame, on, null_safe: bool = True) -> DataFrame:
    """``filter(k %in% other$k)``: keep rows whose key occurs in ``other``."""
    pairs = _pairs(on)
    keys = other.select(*[qcol(rk) for _, rk in pairs]).distinct()
    return join_on(df, keys, on, "left_semi", null_safe)


def anti_join(df: DataFrame, other: DataFrame, on, null_safe: bool = True) -> DataFrame:
    """``filter(!(k %in% other$k))``: a NULL key is kept unless ``other`` holds NULL."""
    pairs = _pairs(on)
    keys = other.select(*[qcol(rk) for _, rk in pairs]).distinct()
    return join_on(df, keys, on, "left_anti", null_safe)


def semi_join_either(df: DataFrame, key: str, sets: Sequence[tuple[DataFrame, str]],
                     null_safe: bool = True) -> DataFrame:
    """``filter(k %in% A$a | k %in% B$b)`` as one hash semi-join on the union of the sets.

    An OR of two semi-join conditions would be planned as a nested-loop
    join; the union of the key sets keeps it an equi-join.
    """
    keyset = None
    for frame, col in sets:
        part = frame.select(qcol(col).alias("__k__"))
        keyset = part if keyset is None else keyset.unionByName(part)
    return join_on(df, keyset.distinct(), {key: "__k__"}, "left_semi", null_safe)


def exclude_values(df: DataFrame, key: str, values) -> DataFrame:
    """Remove known bad records given as a literal list: ``filter(!(k %in% c(...)))``.

    A plain filter (NULL keys kept unless ``None`` is listed) that Spark pushes into the scan;
    no join and no shuffle.
    """
    from ..functions.nulls import not_member
    return df.filter(not_member(key, list(values)))


def exclude_keys(df: DataFrame, key: str, exclusions: DataFrame, exclusion_key: str | None = None) -> DataFrame:
    """Remove records whose key is listed in an exclusion table (null-safe anti join).

    The planner (or AQE, from real sizes) broadcasts a short list, so that
    the large side is not shuffled for a handful of ids.
    """
    return anti_join(df, exclusions, {key: exclusion_key or key})


def keep_keys_in_other(df: DataFrame, key: str, other: DataFrame, other_key: str | None = None) -> DataFrame:
    """Keep rows whose key occurs in ``other``: the reduced form of
    ``filter(!(k %in% setdiff(all$k, other$k)))`` when every key of ``df``
    comes from ``df`` itself."""
    return semi_join(df, other, {key: other_key or key})


def join_suffixed(left: DataFrame, right: DataFrame, on, how: str = "left",
                  suffix: tuple[str, str] = ("", ".y"), null_safe: bool = True) -> DataFrame:
    """dplyr join with ``suffix``: non-key columns present on both sides are renamed."""
    pairs = _pairs(on)
    lkeys = {lk for lk, _ in pairs}
    rkeys = {rk for _, rk in pairs}
    clash = (set(left.columns) - lkeys) & (set(right.columns) - rkeys)
    lsuf, rsuf = suffix
    l2 = left.select(*[qcol(c).alias(c + lsuf if c in clash else c) for c in left.columns])
    r2 = right.select(*[qcol(c).alias(c + rsuf if c in clash else c) for c in right.columns])
    return join_on(l2, r2, on, how, null_safe)
