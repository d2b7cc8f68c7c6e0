"""Fill missing coordinates from records of the same place (country, state, county, locality)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import present
from ..operators.dedup import first_per_key
from ..operators.frames import union_strict
from ..operators.joins import join_on
from ..operators.ranking import sort_rows
from ..session import staged

PLACE_KEYS = ("countryCode", "stateProvince", "county", "locality")
FLAGS = ("cc_zero", "cc_equ", "clean_tests", "cc_err")


def fill_by_locality(occs: DataFrame, order_by: Sequence[str | Column], keys: Sequence[str] = PLACE_KEYS,
                     lat: str = "decimalLatitude", lon: str = "decimalLongitude",
                     flags: Sequence[str] = FLAGS, georef: str = "georeferenced",
                     locality: str = "locality", state: str = "stateProvince",
                     distinct_untouched: bool = True, record_id: str | None = None,
                     sort_output: bool = False) -> DataFrame:
    """Give records without latitude the coordinates of the first georeferenced record
    of the same place (NULL county matches NULL county).

    Reference places: georeferenced, non-blank locality, state present; one
    per place, first in ``order_by``. Targets: latitude missing and a
    non-blank locality (longitude is not tested). A filled record gets all
    flags TRUE, ``georeferenced`` and ``coordsAdded`` TRUE. Everything else
    passes through (distinct rows, as the reference's set difference) with
    ``coordsAdded`` FALSE and is never shuffled for the join.

    With ``record_id`` the de-duplication stays exact but cheap: rows with
    different ids cannot be equal, so only rows whose id occurs more than
    once go through a full-row ``distinct``; finding them shuffles the id
    column alone, and the (usually small) set of repeated ids is a
    semi/anti-join side that AQE can broadcast.
    """
    keys = list(keys)
    ref_rows = occs.filter((F.col(georef) == F.lit(True)) & present(locality) & F.col(state).isNotNull())
    ref = first_per_key(ref_rows, keys, order_by).select(
        *keys, F.col(lat).alias("__lat_y__"), F.col(lon).alias("__lon_y__"))
    is_target = F.col(lat).isNull() & present(locality)
    untouched = occs.filter(~is_target)
    if distinct_untouched and record_id is None:
        untouched = untouched.distinct()
    elif distinct_untouched:
        repeated = (untouched.groupBy(record_id).agg(F.count(F.lit(1)).alias("__n__"))
                    .filter(F.col("__n__") > 1).select(record_id))
        repeated = staged(repeated, "repeated")          # of known size: if it is small, the wide rows are not shuffled
        once = join_on(untouched, repeated, record_id, "left_anti")
        many = join_on(untouched, repeated, record_id, "left_semi").distinct()
        untouched = union_strict(once, many)
    untouched = untouched.withColumn("coordsAdded", F.lit(False))
    targets = occs.filter(is_target)
    m = join_on(targets, ref, keys, "left", null_safe=True)
    m = (m.withColumn(lat, F.coalesce(F.col(lat), F.col("__lat_y__")))
          .withColumn(lon, F.coalesce(F.col(lon), F.col("__lon_y__")))
          .drop("__lat_y__", "__lon_y__"))
    has = F.col(lat).isNotNull()
    m = m.withColumn("coordsAdded", has)
    for f in flags:
        m = m.withColumn(f, F.when(has, F.lit(True)).otherwise(F.col(f)))
    m = m.withColumn(georef, has)
    out = union_strict(untouched, m.select(*untouched.columns))
    # the reference puts records back in their input order; Spark keeps none, so sort on the order key
    return sort_rows(out, list(order_by)) if sort_output else out
